"""Run log: one start row and one end/failed row per logged task."""

from __future__ import annotations

import contextlib
import datetime as dt
import logging
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.timeparts import format_timestamp
from ..sources.tables import append_log_rows

_log = logging.getLogger("tripwright")


class LogWriter:
    """Keeps a run's log rows and appends them in two files: the first row as
    soon as it is there, so that a run that dies leaves its start, the others
    together when the writer is closed.  Writes go through a background thread
    and overlap with the run's own jobs."""

    def __init__(self, spark: SparkSession, log_path: str | None):
        self.spark = spark
        self.log_path = log_path
        self._pool = ThreadPoolExecutor(max_workers=1, thread_name_prefix="tripwright-log")
        self._started = False
        self._rows: list[dict] = []

    def write(self, row: dict) -> None:
        if not self.log_path:
            return
        if self._started:
            self._rows.append(dict(row))
        else:
            self._started = True
            self._pool.submit(self._append, [dict(row)])

    def _append(self, rows: list[dict]) -> None:
        try:
            append_log_rows(self.spark, self.log_path, rows)
        except Exception as exc:  # noqa: BLE001 - logging must not break the task
            _log.warning("could not write log rows: %s", exc)

    def close(self) -> None:
        rows, self._rows = self._rows, []
        self._pool.submit(self._append, rows)
        self._pool.shutdown(wait=True)


@contextlib.contextmanager
def logged(spark: SparkSession, log: "str | LogWriter | None", log_name: str, event: str,
           pipeline_version_instance: str = "v1"):
    """Log ``start`` before the block and ``end``/``failed`` after it, with
    the elapsed seconds.  A failing log write never fails the task.  ``log``
    is a log folder or the ``LogWriter`` of a run with several tasks."""
    own = not isinstance(log, LogWriter)
    writer = LogWriter(spark, log) if own else log
    start = dt.datetime.now()
    base = {"log_name": log_name, "pipeline_version_instance": pipeline_version_instance,
            "event": event}

    def write(event_type, when, duration):
        writer.write(dict(base, event_type=event_type, execution_date_time=when,
                          duration_sec=duration))

    write("start", start, 0.0)
    try:
        yield
    except BaseException:
        now = dt.datetime.now()
        write("failed", now, (now - start).total_seconds())
        if own:
            writer.close()
        raise
    now = dt.datetime.now()
    write("end", now, (now - start).total_seconds())
    if own:
        writer.close()


def last_event(log: DataFrame, id_col: str = "log_id", event_col: str = "event",
               type_col: str | None = "event_type", ts_col: str = "execution_date_time",
               as_written: bool = False, both: bool = False) -> DataFrame:
    """The most recent log row: (event, event_type, execution_date_time text);
    ``both`` adds the other format as ``execution_date_time_as_written``.

    ``orderBy(desc).limit(1)`` plans as a top-1 (TakeOrderedAndProject): each
    task keeps its local maximum, no full sort.
    """
    cols = [F.col(event_col).alias("event")]
    if type_col:
        cols.append(F.col(type_col).alias("event_type"))
    cols.append(format_timestamp(ts_col, as_written).alias("execution_date_time"))
    if both:
        cols.append(format_timestamp(ts_col, True).alias("execution_date_time_as_written"))
    return log.orderBy(F.col(id_col).desc()).limit(1).select(*cols)
