"""Delivery batches carved out of the driver data for incremental-load runs.

Every scenario covers whole tables: the batches together hold every trip.

* calendar batches - ``A`` = trips on days 1-20 of the month, ``B`` = days
  11-31.  They overlap on days 11-20, so loading A, B and A again must equal
  loading everything once.
* area batches - one batch per TPC-H region key of the customer's nation, in
  key order, so dimension members arrive over several loads.
* dirty delivery - the whole stage with faults by event number: NULL fields,
  malformed points, over-long texts, trailing blanks, times on and just outside
  the declared month, and rows delivered twice.
* first delivery - one datasource's file for one area (datasource 'click',
  nations of region key 0); the whole stage is then compared against it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.adapter import read_sf, stage_from_events, stage_from_sf
from .pipeline import PipelineOptions, warehouse_for

# Fixed values of the scenarios.
BATCH_A_LAST_DAY = 20
BATCH_B_FIRST_DAY = 11
FIRST_DELIVERY_DATASOURCE = "click"
FIRST_DELIVERY_REGION_KEY = 0

# Fixed values of the dirty delivery: (column, every n-th event, replacement).
# A replacement is a literal (None: NULL) or, as ('pad', n), the value padded
# with n blanks.  Later faults win over earlier ones on the same column.
FAULTS = [
    ("region", 23, None),
    ("region", 29, "x" * 51),
    ("region", 31, ("pad", 60)),
    ("origin_coord", 37, "POINT (7.1)"),
    ("origin_coord", 41, "POINT (45.0d 7.5)"),
    ("origin_coord", 43, "POINT (1e400 7.5)"),
    ("destination_coord", 47, None),
    ("destination_coord", 53, "POINT (NaN 45.5)"),
    ("destination_coord", 59, "y" * 256),
    ("datetime", 61, "2024-01-01 00:00:00"),
    ("datetime", 67, "2024-02-01 00:00:00"),
    ("datetime", 71, "2023-12-31 23:59:59"),
    ("datetime", 73, None),
    ("datasource", 79, None),
]
TWICE_EVERY = 19


def calendar_batch(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    day = F.dayofmonth("ts")
    if name == "A":
        return stage_from_sf(spark, sf_dir, events_filter=day <= BATCH_A_LAST_DAY)
    if name == "B":
        return stage_from_sf(spark, sf_dir, events_filter=day >= BATCH_B_FIRST_DAY)
    raise ValueError(name)


def dirty_stage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stage of all events with ``FAULTS``, every ``TWICE_EVERY``-th row twice."""
    ev = read_sf(spark, sf_dir, "events")
    rows = stage_from_events(ev, read_sf(spark, sf_dir, "customer"), read_sf(spark, sf_dir, "nation"),
                             keep=["event_id"])
    for column, every, value in FAULTS:
        kind = rows.schema[column].dataType
        if isinstance(value, tuple):
            new = F.concat(F.col(column), F.lit(" " * value[1]))
        else:
            new = F.lit(value).cast(kind)
        rows = rows.withColumn(column, F.when(F.col("event_id") % every == 0, new).otherwise(F.col(column)))
    copies = F.when(F.col("event_id") % TWICE_EVERY == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return rows.withColumn("copy", F.explode(copies)).drop("copy", "event_id")


def dirty_warehouse(spark: SparkSession, sf_dir: str):
    """A warehouse loaded leniently from the dirty delivery, once per session."""
    return warehouse_for(spark, sf_dir, PipelineOptions(strict=False), dirty_stage)


def delivery_files(spark: SparkSession, batches: list[DataFrame], folder: str, files: int = 2) -> str:
    """Batches as parquet files of one folder, ``files`` each, in order of
    delivery (a file stream takes them by age)."""
    for b in batches:
        b.repartition(files).write.mode("append").parquet(folder)
    return folder


def area_keys(spark: SparkSession, sf_dir: str) -> list[int]:
    """Region keys in order - one row per TPC-H region, a fixed small table."""
    return [r[0] for r in read_sf(spark, sf_dir, "region").select("r_regionkey")
            .distinct().orderBy("r_regionkey").collect()]


def area_batch(spark: SparkSession, sf_dir: str, region_key: int) -> DataFrame:
    return stage_from_sf(spark, sf_dir, nation_filter=F.col("n_regionkey") == F.lit(region_key))


def first_delivery(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stage_from_sf(
        spark, sf_dir,
        events_filter=F.col("event_type") == F.lit(FIRST_DELIVERY_DATASOURCE),
        nation_filter=F.col("n_regionkey") == F.lit(FIRST_DELIVERY_REGION_KEY))
