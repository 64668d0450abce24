"""Named questions asked of the warehouse (all DataFrame in / DataFrame out).

Dimension lookups carry no join hint: the planner broadcasts a side whose size
in bytes is under its threshold, and adaptive execution decides again at run
time.  Every aggregate over the fact is a hash aggregate whose partial
(map-side) step collapses hot regions or days before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.geo import box_contains
from ..functions.keys import event_id_hex
from ..functions.timeparts import day_start, format_day
from ..operators.spatial import points_in_boxes


def list_dim(dim: DataFrame) -> DataFrame:
    """All rows of a dimension (regions or datasources)."""
    return dim


def regions_of_datasource(fact: DataFrame, dim_region: DataFrame, dim_datasource: DataFrame,
                          datasource: str) -> DataFrame:
    """Distinct regions in which ``datasource`` has trips."""
    ids = dim_datasource.where(F.col("datasource") == F.lit(datasource)).select("datasource_id")
    region_ids = (fact.select("datasource_id", "region_id")
                      .join(ids, "datasource_id", "left_semi")
                      .select("region_id").distinct())
    return (region_ids.join(dim_region, "region_id", "inner")
                      .select("region").distinct())


def region_trip_stats(fact: DataFrame) -> DataFrame:
    """(region_id, number_of_trips, event_timestamp = latest trip time)."""
    return fact.groupBy("region_id").agg(
        F.count("region_id").alias("number_of_trips"),
        F.max("event_timestamp").alias("event_timestamp"))


def region_rank(fact: DataFrame) -> DataFrame:
    """Regions numbered by trip count, busiest first (ties: lower id first).

    The window has no partition, but it runs over one row per region - an
    aggregated result whose size is the number of regions, not of trips.
    """
    w = Window.orderBy(F.col("number_of_trips").desc(), F.col("region_id").asc())
    return region_trip_stats(fact).select(
        "region_id", "number_of_trips", "event_timestamp",
        F.row_number().over(w).cast("bigint").alias("rownumber"))


def latest_datasource_top(fact: DataFrame, dim_region: DataFrame, dim_datasource: DataFrame,
                          k: int = 2) -> DataFrame:
    """For the ``k`` busiest regions: the datasource of the latest trip
    (lexicographic max when several share that instant) and its time.

    One scan of the fact, into a row per (region, datasource): the regions'
    counts, their latest time and the datasources at it all follow from that.
    """
    pairs = fact.groupBy("region_id", "datasource_id").agg(
        F.count("region_id").alias("trips"), F.max("event_timestamp").alias("latest"))
    regions = (pairs.join(dim_datasource, "datasource_id").groupBy("region_id")
               .agg(F.sum("trips").alias("trips"), F.max(F.struct("latest", "datasource")).alias("last")))
    top = regions.orderBy(F.col("trips").desc(), F.col("region_id").asc()).limit(k)
    return top.join(dim_region, "region_id").select(
        "region", "last.datasource", F.col("last.latest").alias("event_timestamp"))


def weekly_trips(group: DataFrame, dim_region: DataFrame, dim_day: DataFrame,
                 by_year: bool = False) -> DataFrame:
    """Trips per (ISO week, region).  The week comes from the day starts of the
    time dimension, which have a small table of their own: a row per calendar
    day, where the dimension has one per trip time.  by_year=False groups by week
    number only (weeks of different years merge, as the original query does);
    by_year=True adds the ISO week-based year."""
    mid = dim_day.select(F.col("event_timestamp").alias("event_date"), "week")
    j = (group.select("event_date", "region_id", "number_of_trips")
              .join(mid, "event_date", "inner")
              .join(dim_region, "region_id", "inner"))
    keys = ["week", "region"]
    if by_year:
        j = j.withColumn("iso_year", F.extract(F.lit("YEAROFWEEK"), F.col("event_date")).cast("int"))
        keys = ["iso_year"] + keys
    return j.groupBy(*keys).agg(F.sum("number_of_trips").cast("bigint").alias("number_of_trips"))


def weekly_avg_trips(group: DataFrame, dim_region: DataFrame, dim_day: DataFrame,
                     by_year: bool = False) -> DataFrame:
    """Average weekly trip count per region (average over its weeks)."""
    w = weekly_trips(group, dim_region, dim_day, by_year)
    return w.groupBy("region").agg(F.avg("number_of_trips").alias("avg_weekly_trips"))


def check_position(group: DataFrame, dim_region: DataFrame, x: float, y: float) -> DataFrame:
    """(region, event_date text, number_of_trips) of every (day, region) box
    covering the point (x = longitude, y = latitude), edges inclusive.

    The four comparisons on the box fields are pushed to the parquet scan.
    """
    hits = group.where(box_contains("box_coord", float(x), float(y)))
    return (hits.join(dim_region, "region_id", "inner")
                .select("region", format_day("event_date").alias("event_date"),
                        F.col("number_of_trips").cast("bigint").alias("number_of_trips")))


def flat_group(group: DataFrame) -> DataFrame:
    """Group fact with the box as four flat columns (for comparisons)."""
    return group.select("event_date", "region_id",
                        F.col("box_coord.x0").alias("box_x0"), F.col("box_coord.y0").alias("box_y0"),
                        F.col("box_coord.x1").alias("box_x1"), F.col("box_coord.y1").alias("box_y1"),
                        F.col("number_of_trips").cast("bigint").alias("number_of_trips"))


def trip_origins_in_boxes(fact: DataFrame, group: DataFrame, cell: float = 1.0) -> DataFrame:
    """Every (trip, region box) pair of one day whose box holds the trip's
    origin.  The day joins with the grid cell, so the pairs grow with the trips
    and not with trips times days."""
    points = fact.select(event_id_hex("event_id").alias("event_id"), "event_timestamp",
                         day_start("event_timestamp").alias("event_date"),
                         F.col("origin_coord.x").alias("x"), F.col("origin_coord.y").alias("y"))
    boxes = group.select("event_date", F.col("region_id").alias("box_region_id"), "box_coord")
    return points_in_boxes(points, boxes, "x", "y", "box_coord", cell, on=["event_date"]).select(
        "event_id", "event_timestamp", "event_date", "box_region_id")
