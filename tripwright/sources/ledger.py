"""File-level ingest ledger: skip input files that were already loaded.

New files are dealt to batches by size, in order of delivery, and the batches are
kept as a table, the plan.  Names stay in Spark's tables; a batch's names, which
are bounded in number, are all that a load takes from it.  A plan that was begun
is finished before the next is made.
"""

from __future__ import annotations

import uuid
from itertools import accumulate

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import default_parallelism, delete_path, ensure_checkpoint_dir, path_exists

FILES = T.StructType([
    T.StructField("path", T.StringType()),
    T.StructField("length", T.LongType()),
    T.StructField("modificationTime", T.TimestampType()),
])
LEDGER = T.StructType([*FILES.fields, T.StructField("batch_id", T.StringType())])
PLAN = T.StructType([*FILES.fields, T.StructField("batch", T.LongType())])

BATCH_BYTES = 64 << 30
BATCH_FILES = 10_000


def list_files(spark: SparkSession, pattern: str) -> DataFrame:
    """(path, length, modificationTime) of every file matching ``pattern``.

    The ``binaryFile`` source reads file contents only when the ``content``
    column is selected, so this is a metadata listing.
    """
    return (spark.read.format("binaryFile").load(pattern)
            .select("path", "length", "modificationTime"))


def new_files(spark: SparkSession, pattern: str, ledger_path: str) -> DataFrame:
    """Files under ``pattern`` not yet recorded in the ledger (by path+length+mtime)."""
    files = list_files(spark, pattern)
    if not path_exists(spark, ledger_path):
        return files
    seen = spark.read.schema(LEDGER).parquet(ledger_path).select("path", "length", "modificationTime")
    return files.join(seen, ["path", "length", "modificationTime"], "left_anti")


def record_files(files: DataFrame, ledger_path: str, batch_id: str) -> None:
    files.select("path", "length", "modificationTime",
                 F.lit(batch_id).alias("batch_id")).write.mode("append").parquet(ledger_path)


def deal_batches(files: DataFrame, batch_bytes: int = BATCH_BYTES, batch_files: int = BATCH_FILES) -> DataFrame:
    """``files`` with the number of their ``batch``: in order of time and path,
    cut after every ``batch_bytes`` and every ``batch_files``, so that a batch
    has no more files than that and, but for its last one, no more bytes.

    A running sum without a single-task window: files are range-partitioned by
    that order and pinned, sums run inside a partition, and the totals before
    each partition - a row per partition - are joined on.
    """
    spark = files.sparkSession
    ensure_checkpoint_dir(spark)
    order = ["modificationTime", "path"]
    ranged = files.repartitionByRange(default_parallelism(spark), *order).sortWithinPartitions(*order)
    ranged = ranged.withColumn("_p", F.spark_partition_id()).checkpoint(eager=True)
    totals = sorted(tuple(r) for r in ranged.groupBy("_p").agg(F.sum("length"), F.count("*")).collect())
    before = zip(accumulate((b for _, b, _ in totals), initial=0), accumulate((n for *_, n in totals), initial=0))
    offsets = spark.createDataFrame([(p, b, n) for (p, *_), (b, n) in zip(totals, before)], "_q int, _bytes long, _files long")
    own = Window.partitionBy("_p").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    placed = (ranged.select("*", F.coalesce(F.sum("length").over(own), F.lit(0)).alias("_b"), F.count("*").over(own).alias("_n"))
              .join(F.broadcast(offsets), F.col("_p") == F.col("_q")))          # a row per partition
    by_bytes, by_files = (F.floor((F.col(a) + F.col(b)) / F.lit(size)) for a, b, size in (
        ("_b", "_bytes", batch_bytes), ("_n", "_files", batch_files)))
    # Every cut of either kind begins a batch.
    return placed.select("path", "length", "modificationTime", (by_bytes + by_files).cast("long").alias("batch"))


def open_plan(spark: SparkSession, plans: str, pattern: str, ledger_path: str, batch_bytes: int = BATCH_BYTES,
              batch_files: int = BATCH_FILES) -> tuple[str, str] | None:
    """``(folder, id)`` of the plan to load: the one that was begun, else a new
    one over the new files; None if there are none."""
    begun = f"{plans}/open"
    if not path_exists(spark, f"{begun}/files/_SUCCESS"):
        delete_path(spark, begun)
        deal_batches(new_files(spark, pattern, ledger_path), batch_bytes, batch_files).write.parquet(f"{begun}/files")
    rows = spark.read.schema(PLAN).parquet(f"{begun}/files")
    if rows.isEmpty():
        delete_path(spark, begun)
        return None
    if not path_exists(spark, f"{begun}/id/_SUCCESS"):
        spark.createDataFrame([(uuid.uuid4().hex,)], "id string").write.mode("overwrite").parquet(f"{begun}/id")
    return begun, spark.read.schema("id string").parquet(f"{begun}/id").first().id


def plan_batches(spark: SparkSession, folder: str, plan_id: str, ledger_path: str):
    """The batches of a plan that are not in the ledger, in order, as ``(batch
    id, files)``; numbers only are brought to the driver."""
    files = spark.read.schema(PLAN).parquet(f"{folder}/files")
    for r in files.select("batch").distinct().orderBy("batch").toLocalIterator():
        batch_id = f"{plan_id}-{r.batch}"
        done = path_exists(spark, ledger_path) and not spark.read.schema(LEDGER).parquet(ledger_path).where(
            F.col("batch_id") == batch_id).isEmpty()
        if not done:
            yield batch_id, files.where(F.col("batch") == r.batch)
