"""Trip facts: delta build, insert-if-absent, daily group aggregate."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.geo import box, case_lower, case_upper, with_points
from ..functions.keys import event_id
from ..functions.timeparts import day_start
from ..schemas import PRIMARY_KEYS

FACT_KEY = PRIMARY_KEYS["fact_trips"]
GROUP_KEY = PRIMARY_KEYS["fact_group_trips"]


POINT_COLUMNS = ("origin_coord", "destination_coord")


def _unpacked(c: str, x, y) -> list:
    """A point as fixed-width columns: a NULL flag and two doubles."""
    return [F.col(c).isNull().alias(f"_{c}_null"), x.alias(f"_{c}_x"), y.alias(f"_{c}_y")]


def _packed(c: str):
    return F.when(F.col(f"_{c}_null"), F.lit(None)).otherwise(
        F.struct(F.col(f"_{c}_x").alias("x"), F.col(f"_{c}_y").alias("y"))).alias(c)


def dedupe_on_key(df: DataFrame, keys: list[str]) -> DataFrame:
    """One row per key, through a hash aggregate.

    ``dropDuplicates`` keeps the first value of every other column; over
    struct columns that buffer is not fixed-width and Spark falls back to a
    sort-based aggregate.  The point structs are split into their doubles
    plus a NULL flag for the aggregate and rebuilt after it, so the plan is
    a partial + final HashAggregate (copies collapse map-side, no sort).
    """
    points = [c for c in POINT_COLUMNS if c in df.columns]
    flat = df.select(*[c for c in df.columns if c not in points],
                     *[u for c in points for u in _unpacked(c, F.col(c)["x"], F.col(c)["y"])])
    out = flat.dropDuplicates(keys)
    return out.select(*[_packed(c) if c in points else F.col(c) for c in df.columns])


def build_delta(stage: DataFrame, dim_region: DataFrame, dim_datasource: DataFrame,
                on_duplicate: str = "drop", strict: bool = True) -> DataFrame:
    """Typed delta fact of a staged batch.

    Star lookup of both surrogate keys (inner joins: rows whose region or
    datasource has no dimension member drop out), MD5 event id over the raw
    text, WKT points parsed to structs.

    on_duplicate: ``drop`` keeps one row per (event_timestamp, event_id);
    ``fail`` raises, when the delta is evaluated, if the batch holds a
    duplicate key (the behaviour of the original insert); ``keep`` leaves duplicates in.
    """
    s = stage.where(F.col("region").isNotNull() & F.col("datasource").isNotNull())
    ts = F.col("datetime")
    if strict:
        # The timestamp is part of the key: a NULL aborts a strict load, in
        # the same pass (lenient loads quarantine such rows beforehand).
        ts = F.when(ts.isNull(), F.raise_error(F.lit("NULL datetime in a staged trip"))) \
              .otherwise(ts)
    else:
        s = s.where(ts.isNotNull())
    j = (s.join(dim_region.select("region_id", "region"), "region", "inner")
          .join(dim_datasource.select("datasource_id", "datasource"), "datasource", "inner"))
    if on_duplicate not in ("drop", "fail", "keep"):
        raise ValueError(f"on_duplicate must be drop, fail or keep, not {on_duplicate!r}")
    # Coordinates are parsed once into flat doubles (plus a NULL-point flag);
    # the key de-duplication runs on those fixed-width columns (a hash
    # aggregate) and the point structs are packed afterwards.
    cols = [ts.cast("timestamp_ntz").alias("event_timestamp"),
            event_id().alias("event_id"),
            F.col("region_id").cast("int").alias("region_id"),
            F.col("datasource_id").cast("int").alias("datasource_id")]
    flat = with_points(j.select(*cols, *POINT_COLUMNS), POINT_COLUMNS, strict)
    if on_duplicate == "drop":
        flat = flat.dropDuplicates(FACT_KEY)
    elif on_duplicate == "fail":
        # In the pass that uses the delta: a second row of a key raises.
        copies = F.count(F.lit(1)).over(Window.partitionBy(*FACT_KEY))
        flat = flat.withColumn("event_timestamp", F.when(copies > 1, F.raise_error(F.lit(
            "batch holds duplicate (event_timestamp, event_id) keys"))).otherwise(F.col("event_timestamp")))
    return flat.select("event_timestamp", "event_id", "region_id", "datasource_id",
                       *[_packed(c) for c in POINT_COLUMNS])


def insert_if_absent(delta: DataFrame, existing: DataFrame, keys: list[str] = FACT_KEY,
                     dedupe: bool = True) -> DataFrame:
    """Rows of ``delta`` whose key is not in ``existing`` (one per key unless
    ``dedupe=False`` for a delta already unique on ``keys``).

    ``existing`` should already be narrowed to the days the batch touches
    (``tables.days_filter``): the key contains the timestamp, so no other
    day can match.  With a shuffle join the de-duplication and the anti-join
    hash and sort on the same keys, so the delta side is exchanged once.
    """
    d = dedupe_on_key(delta, keys) if dedupe else delta
    return d.join(existing.select(*keys), keys, "left_anti")


def group_extremes(fact: DataFrame) -> DataFrame:
    """Per (day, region): the extremes of the trips' lower and upper corners
    and their number - all that either kind of box needs, in one aggregate."""
    ox, oy = F.col("origin_coord.x"), F.col("origin_coord.y")
    dx, dy = F.col("destination_coord.x"), F.col("destination_coord.y")
    lx, ly = case_lower(ox, dx), case_lower(oy, dy)
    hx, hy = case_upper(ox, dx), case_upper(oy, dy)
    return (fact.groupBy(day_start("event_timestamp").alias("event_date"), "region_id")
            .agg(F.min(lx).alias("min_lx"), F.min(ly).alias("min_ly"),
                 F.max(lx).alias("max_lx"), F.max(ly).alias("max_ly"),
                 F.max(hx).alias("max_hx"), F.max(hy).alias("max_hy"),
                 F.count(F.lit(1)).cast("bigint").alias("number_of_trips")))


# How rows of one (day, region) merge, column by column.
MERGE = {"min_lx": F.min, "min_ly": F.min, "max_lx": F.max, "max_ly": F.max, "max_hx": F.max,
         "max_hy": F.max, "number_of_trips": F.sum}


def merge_extremes(state: DataFrame, more: DataFrame) -> DataFrame:
    """``group_extremes`` of all trips from those of some and those of the rest:
    minima, maxima and sums, so no trip is read again."""
    columns = [*GROUP_KEY, *MERGE]
    return (state.select(*columns).unionByName(more.select(*columns)).groupBy(*GROUP_KEY)
            .agg(*[f(c).alias(c) for c, f in MERGE.items()]))


def group_boxes(extremes: DataFrame, kind: str = "as_written") -> DataFrame:
    """Group rows of ``group_extremes``: bounding box of the trips and their count.

    ``as_written`` reproduces the original aggregate exactly: the upper corner
    is the MAX of the *lower* CASE arm (the same CASE as the MIN), so it is not
    the true envelope.  ``envelope`` takes the MAX of the upper arm and yields
    the true envelope of all origins and destinations.
    """
    if kind not in ("as_written", "envelope"):
        raise ValueError(f"box must be as_written or envelope, not {kind!r}")
    high = ("max_lx", "max_ly") if kind == "as_written" else ("max_hx", "max_hy")
    return extremes.select(
        "event_date", "region_id", box("min_lx", "min_ly", *high).alias("box_coord"), "number_of_trips",
        F.year("event_date").cast("int").alias("year"),
        F.month("event_date").cast("int").alias("month"))


def group_trips(fact: DataFrame, box: str = "as_written") -> DataFrame:
    """``group_boxes`` of the extremes of ``fact``."""
    return group_boxes(group_extremes(fact), box)
