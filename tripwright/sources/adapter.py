"""Driver test data -> staged trips.

``events`` joined to ``customer`` (user_id = c_custkey) and ``nation``
(c_nationkey = n_nationkey) gives one trip per event: region = nation name,
datasource = event type, datetime = event time.  Coordinates are text built
from integers only, so every engine prints them identically; each nation gets
its own 1 x 1 cell.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values of the adapter's coordinate rule.
COORD_MULTIPLIER = 7919
COORD_MODULUS = 100000
COORD_DIGITS = 5
CELL_X_BASE = 5
CELL_Y_BASE = 45
CELL_ROW_WIDTH = 5


def _coord(base: Column, e: Column) -> Column:
    frac = F.lpad(((e * COORD_MULTIPLIER) % COORD_MODULUS).cast("string"), COORD_DIGITS, "0")
    return F.concat(base.cast("string"), F.lit("."), frac)


def _wkt(x: Column, y: Column) -> Column:
    return F.concat(F.lit("POINT ("), x, F.lit(" "), y, F.lit(")"))


def stage_from_events(events: DataFrame, customer: DataFrame, nation: DataFrame,
                      keep: list[str] | None = None) -> DataFrame:
    """Staged trips (schema ``schemas.TRIPS``) from the three driver tables;
    ``keep`` names event columns to carry along.

    No join hint: customer and nation are dimension scans whose on-disk size
    Catalyst knows, so each is broadcast when under
    ``spark.sql.autoBroadcastJoinThreshold`` and shuffle-joined otherwise.
    Events are joined to customer first: joining customer to nation first
    would inflate that side's size estimate (a join's estimate is roughly the
    product of its inputs) and turn the events side into the broadcast one.
    A hot user_id in a shuffle join is split by AQE's skew-join handling.
    """
    e = events.select("event_id", "ts", "user_id", "event_type")
    c = customer.select("c_custkey", "c_nationkey")
    n = nation.select("n_nationkey", "n_name")
    ec = e.join(c, e.user_id == c.c_custkey, "inner")
    j = ec.join(n, ec.c_nationkey == n.n_nationkey, "inner")
    bx = F.lit(CELL_X_BASE) + F.col("n_nationkey") % CELL_ROW_WIDTH
    by = F.lit(CELL_Y_BASE) + F.col("n_nationkey") - F.col("n_nationkey") % CELL_ROW_WIDTH
    uid, eid = F.col("user_id"), F.col("event_id")
    return j.select(
        F.col("n_name").alias("region"),
        _wkt(_coord(bx, uid + eid), _coord(by, uid * 3 + eid)).alias("origin_coord"),
        _wkt(_coord(bx, eid * 11 + uid), _coord(by, eid * 13)).alias("destination_coord"),
        F.col("ts").cast("timestamp_ntz").alias("datetime"),
        F.col("event_type").alias("datasource"),
        *(keep or []),
    )


def read_sf(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stage_from_sf(spark: SparkSession, sf_dir: str, events_filter: Column | None = None,
                  nation_filter: Column | None = None) -> DataFrame:
    """Adapter over a driver data folder.  Optional filters select a delivery
    batch (e.g. by calendar day or by area) for incremental-load scenarios."""
    ev = read_sf(spark, sf_dir, "events")
    na = read_sf(spark, sf_dir, "nation")
    if events_filter is not None:
        ev = ev.where(events_filter)
    if nation_filter is not None:
        na = na.where(nation_filter)
    return stage_from_events(ev, read_sf(spark, sf_dir, "customer"), na)
