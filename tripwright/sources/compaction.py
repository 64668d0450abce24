"""Compaction of month partitions: many small files become few of a given size.

Every append adds files to the months it touches.  A month with more files than
its bytes ask for is rewritten, in time order, beside the table first and then
swapped in by a dynamic partition overwrite.  A run that dies leaves the rewritten
months where they are, and the next one swaps them in again before anything else
reads the table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import delete_path, folder_size, path_exists, rename_path
from .ledger import list_files
from .tables import TablePaths, months_filter, read_table, write_monthly

FILE_BYTES = 256 << 20
SPARE_FILES = 16       # small files that a month may have beside the full ones


def month_files(spark: SparkSession, paths: TablePaths, table: str) -> DataFrame:
    """``(year, month, files, bytes)`` of a table's folders, from their listing."""
    part = F.regexp_extract("path", r"year=(\d+)/month=(\d+)/[^/]*$", 1), F.regexp_extract(
        "path", r"year=(\d+)/month=(\d+)/[^/]*$", 2)
    return (list_files(spark, f"{paths.path(table)}/year=*/month=*/*.parquet")
            .groupBy(part[0].cast("int").alias("year"), part[1].cast("int").alias("month"))
            .agg(F.count("*").alias("files"), F.sum("length").alias("bytes")))


def _aside(paths: TablePaths, table: str) -> str:
    return f"{paths.root.rstrip('/')}/_staging/compact/{table}"


def finish_compaction(spark: SparkSession, paths: TablePaths, table: str, ts_col: str = "event_timestamp",
                      files: int | None = None) -> None:
    """Swap in what an earlier run rewrote, if it did so completely."""
    aside = _aside(paths, table)
    if path_exists(spark, f"{aside}/_SUCCESS"):
        rows = spark.read.schema(paths.schema(table)).parquet(aside)
        write_monthly(rows, ts_col, paths.path(table), mode="overwrite", dynamic=True, files=files)
        closed = f"{aside}-closed"            # one rename: half a folder would look whole
        rename_path(spark, aside, closed)
        aside = closed
    delete_path(spark, aside)


def compact_months(spark: SparkSession, paths: TablePaths, table: str, months: list[tuple[int, int]] | None = None,
                   ts_col: str = "event_timestamp", file_bytes: int = FILE_BYTES,
                   spare: int = SPARE_FILES) -> list[tuple[int, int]]:
    """Rewrite the months (of those given, else of all) that have more than
    ``spare`` files beyond those their bytes fill; returns them.

    Files are cut by ranges of time, so those of a month don't overlap any more
    and day filters skip them.  The list of months is bounded by the calendar.
    """
    finish_compaction(spark, paths, table, ts_col)
    if not path_exists(spark, paths.path(table)):
        return []
    if months is None:
        sizes = [tuple(r) for r in month_files(spark, paths, table).collect()]
    else:      # a few folders: no job for their listing
        sizes = [(y, m, *folder_size(spark, f"{paths.path(table)}/year={y}/month={m}")) for y, m in months]
    rows = [(y, m, -(-size // file_bytes)) for y, m, n, size in sizes if n > -(-size // file_bytes) + spare]
    if not rows:
        return []
    files = sum(need for *_, need in rows)
    found = sorted((y, m) for y, m, _ in rows)
    read_table(spark, paths, table).where(months_filter(found)).write.mode("overwrite").parquet(_aside(paths, table))
    finish_compaction(spark, paths, table, ts_col, files)
    return found
