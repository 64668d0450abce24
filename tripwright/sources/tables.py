"""Parquet tables of the warehouse: paths, typed reads, month-partitioned writes."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas
from ..functions.geo import curve_position
from ..functions.timeparts import ntz_literal
from ..session import path_exists

# Table name -> (schema folder, declared schema).  The three folders mirror the
# namespaces of the original warehouse: staging, final tables, logs.
TABLES = {
    "trips": ("trips_stage", schemas.TRIPS),
    "fact_delta_trips": ("trips_stage", schemas.FACT_DELTA),
    "dim_region": ("trips", schemas.DIM_REGION),
    "dim_datasource": ("trips", schemas.DIM_DATASOURCE),
    "dim_event_time": ("trips", schemas.DIM_EVENT_TIME),
    # The day starts of dim_event_time on their own: a row per calendar day.
    "dim_day": ("trips", schemas.DIM_EVENT_TIME),
    "fact_trips": ("trips", schemas.FACT_TRIPS),
    "fact_group_trips": ("trips", schemas.FACT_GROUP_TRIPS),
    # True-envelope variant of the group fact (same schema).
    "fact_group_envelope": ("trips", schemas.FACT_GROUP_TRIPS),
    "fact_group_state": ("trips", schemas.GROUP_STATE),
    "trips_log": ("logs", schemas.TRIPS_LOG),
}

# Tables stored with month partitions (year=/month= folders).
MONTHLY = {"dim_event_time", "fact_trips", "fact_group_trips", "fact_group_envelope", "fact_group_state"}


@dataclass(frozen=True)
class TablePaths:
    """Where each table lives.  ``root`` is any Hadoop-FS URI (shared storage
    on a cluster).  Replaces templating schema names into SQL text."""

    root: str

    def path(self, table: str) -> str:
        folder, _ = TABLES[table]
        return f"{self.root.rstrip('/')}/{folder}/{table}"

    def schema(self, table: str) -> T.StructType:
        return TABLES[table][1]


def read_table(spark: SparkSession, paths: TablePaths, table: str) -> DataFrame:
    """Typed read; a table that was never written reads as empty with its
    declared schema (idempotent setup without DDL)."""
    schema = paths.schema(table)
    path = paths.path(table)
    if not path_exists(spark, path):
        return spark.createDataFrame([], schema)
    df = spark.read.schema(schema).parquet(path)
    return df.select(*[f.name for f in schema.fields])


def write_stage(df: DataFrame, path: str, mode: str = "overwrite", batch_id: str = "0") -> None:
    """Stage replace (``overwrite``) or append (``append``).  Each batch has a
    folder of its own, so writing a batch again replaces it: a retried or
    replayed append leaves every row once."""
    if mode not in ("overwrite", "append"):
        raise ValueError(f"stage mode must be overwrite or append, not {mode!r}")
    (df.withColumn("batch_id", F.lit(f"b-{batch_id}")).write.mode("overwrite")
       .option("partitionOverwriteMode", "dynamic" if mode == "append" else "static")
       .partitionBy("batch_id").parquet(path))


def with_month_columns(df: DataFrame, ts_col: str) -> DataFrame:
    return (df.withColumn("year", F.year(ts_col).cast("int"))
              .withColumn("month", F.month(ts_col).cast("int")))


def write_monthly(df: DataFrame, ts_col: str, path: str, mode: str = "append",
                  dynamic: bool = True, files: int | None = None) -> None:
    """Write with ``year=/month=`` partitions derived from ``ts_col``.

    Rows are range-partitioned on (year, month, ts): a hot month is split by
    time over several tasks, a batch over many months makes about as many files
    as tasks and months together, and each file holds a narrow time range of its
    own, so filters on ``ts_col`` skip files and row groups.
    ``mode='overwrite'`` with ``dynamic`` replaces only the months present;
    ``files`` asks for about so many ranges.
    """
    out = df if "year" in df.columns and "month" in df.columns else with_month_columns(df, ts_col)
    (out.repartitionByRange(*([files] if files else []), "year", "month", ts_col)
        .sortWithinPartitions("year", "month", ts_col)
        .write.mode(mode)
        .option("partitionOverwriteMode", "dynamic" if dynamic else "static")
        .partitionBy("year", "month")
        .parquet(path))


def write_by_place(df: DataFrame, ts_col: str, path: str, box_col: str = "box_coord",
                   dynamic: bool = True) -> None:
    """Replace the months of ``df`` (all months without ``dynamic``) with its
    rows in the order of a space-filling curve through their boxes' centres.

    Inside a month, files and row groups then hold boxes that lie together, so
    the four comparisons of a position lookup skip nearly all of them by their
    statistics; in order of time each would span every region."""
    b = F.col(box_col)
    out = df if "year" in df.columns and "month" in df.columns else with_month_columns(df, ts_col)
    out = out.withColumn("_place", curve_position((b["x0"] + b["x1"]) / 2, (b["y0"] + b["y1"]) / 2))
    order = ["year", "month", "_place", ts_col]
    (out.repartitionByRange(*order).sortWithinPartitions(*order).drop("_place")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic" if dynamic else "static")
        .partitionBy("year", "month")
        .parquet(path))


def month_predicate(start: dt.datetime | str, end: dt.datetime | str,
                    ts_col: str = "event_timestamp") -> Column:
    """Half-open ``[start, end)`` filter on ``ts_col`` plus the equivalent
    year/month terms, so the scan prunes partitions (a filter on the
    timestamp alone does not reach the partition columns)."""
    s = _as_datetime(start)
    e = _as_datetime(end)
    ym_lo = s.year * 12 + s.month - 1
    last = e - dt.timedelta(microseconds=1)
    ym_hi = last.year * 12 + last.month - 1
    ym = F.col("year") * 12 + F.col("month") - 1
    return ((ym >= ym_lo) & (ym <= ym_hi)
            & (F.col(ts_col) >= ntz_literal(s))
            & (F.col(ts_col) < ntz_literal(e)))


def _as_datetime(v) -> dt.datetime:
    if isinstance(v, dt.datetime):
        return v
    if isinstance(v, dt.date):
        return dt.datetime(v.year, v.month, v.day)
    return dt.datetime.fromisoformat(str(v))


def months_filter(months: list[tuple[int, int]]) -> Column:
    """Partition filter for a list of (year, month)."""
    if not months:
        return F.lit(False)
    keys = sorted({y * 100 + m for y, m in months})
    return (F.col("year") * 100 + F.col("month")).isin(keys)


def days_filter(days: list[dt.date], ts_col: str) -> Column:
    """Rows whose ``ts_col`` falls on one of ``days``: the month partition
    filter plus one half-open range per day (merged when consecutive), so
    both partition pruning and row-group skipping on ``ts_col`` apply."""
    if not days:
        return F.lit(False)
    ds = sorted(set(days))
    ranges, start, prev = [], ds[0], ds[0]
    for d in ds[1:]:
        if d == prev + dt.timedelta(days=1):
            prev = d
            continue
        ranges.append((start, prev))
        start = prev = d
    ranges.append((start, prev))
    t = F.col(ts_col)
    terms = []
    for first, last in ranges:
        end = last + dt.timedelta(days=1)
        terms.append((t >= ntz_literal(dt.datetime(first.year, first.month, first.day)))
                     & (t < ntz_literal(dt.datetime(end.year, end.month, end.day))))
    while len(terms) > 1:      # a balanced tree: sparse days don't make a deep expression
        terms = [terms[i] if i + 1 == len(terms) else terms[i] | terms[i + 1]
                 for i in range(0, len(terms), 2)]
    cond = terms[0]
    months = sorted({(d.year, d.month) for d in ds})
    return months_filter(months) & cond


def months_of(days: list[dt.date]) -> list[tuple[int, int]]:
    return sorted({(d.year, d.month) for d in days})


def touched_days(df: DataFrame, ts_col: str) -> list[dt.date]:
    """Distinct calendar days of a batch (bounded by its calendar span)."""
    rows = (df.select(F.col(ts_col).cast("date").alias("d")).where(F.col("d").isNotNull())
              .distinct().collect())
    return sorted(r.d for r in rows)


def append_log_rows(spark: SparkSession, path: str, rows: list[dict]) -> None:
    """Append log rows as one file.  ``log_id`` continues from the largest id
    present (one writer per warehouse)."""
    if not rows:
        return
    largest = 0
    if path_exists(spark, path):
        largest = spark.read.schema(schemas.TRIPS_LOG).parquet(path).agg(F.max("log_id")).first()[0] or 0
    values = [[{**row, "log_id": largest + i}.get(f.name) for f in schemas.TRIPS_LOG.fields]
              for i, row in enumerate(rows, 1)]
    spark.createDataFrame(values, schemas.TRIPS_LOG).coalesce(1).write.mode("append").parquet(path)


def stage_batch(spark: SparkSession, paths: TablePaths, batch_id: str) -> DataFrame:
    """The staged rows of one batch; the folders of others are not read."""
    path = paths.path("trips")
    if not path_exists(spark, path):
        return spark.createDataFrame([], schemas.TRIPS)
    schema = T.StructType([*schemas.TRIPS.fields, T.StructField("batch_id", T.StringType())])
    return spark.read.schema(schema).parquet(path).where(F.col("batch_id") == f"b-{batch_id}").drop("batch_id")
