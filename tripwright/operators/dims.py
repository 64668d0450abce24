"""Dimension maintenance: insert unseen members, keep existing ids."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.timeparts import day_start, event_time_parts
from ..sources.tables import months_filter
from .ids import dense_ids


def distinct_members(stage: DataFrame, key: str) -> DataFrame:
    """Distinct non-NULL values of ``key``.  NULL members are never inserted
    (a NULL never equals itself, so they would be re-inserted every run);
    they are counted by the quality checks instead."""
    return stage.select(key).where(F.col(key).isNotNull()).distinct()


def new_members(stage: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    """Members of the batch absent from the dimension (anti-join)."""
    return distinct_members(stage, key).join(dim.select(key), key, "left_anti")


def upsert_dim(stage: DataFrame, dim: DataFrame, key: str, id_col: str) -> DataFrame:
    """New dimension rows ``(id_col, key)`` to append.

    Ids continue after the largest existing id, in natural-key order within
    the batch; ids already assigned never change.
    """
    start = dim.agg(F.max(id_col)).first()[0] or 0
    return dense_ids(new_members(stage, dim, key), [key], id_col, start=int(start))


def event_time_members(stage: DataFrame, ts_col: str = "datetime") -> DataFrame:
    """Distinct trip timestamps together with the midnight of their day.

    One scan: each row emits both values through ``explode``; the distinct
    is a hash aggregate whose map-side partial collapses the day values.
    """
    t = F.col(ts_col)
    return (stage.where(t.isNotNull())
            .select(F.explode(F.array(t, day_start(t))).alias("event_timestamp"))
            .distinct())


def event_time_rows(members: DataFrame) -> DataFrame:
    return members.select("event_timestamp", *event_time_parts("event_timestamp"))


def new_event_times(stage: DataFrame, dim_time: DataFrame,
                    months: list[tuple[int, int]] | None = None) -> DataFrame:
    """Timestamps of the batch absent from the time dimension.  ``months``
    restricts the dimension scan to the partitions the batch touches."""
    existing = dim_time if months is None else dim_time.where(months_filter(months))
    return event_time_members(stage).join(existing.select("event_timestamp"),
                                          "event_timestamp", "left_anti")


def fill_event_time(stage: DataFrame, dim_time: DataFrame,
                    months: list[tuple[int, int]] | None = None) -> DataFrame:
    """New time-dimension rows with hour/day/week/month/year/weekday."""
    return event_time_rows(new_event_times(stage, dim_time, months))


def fill_days(spark: SparkSession, days: list[dt.date], dim_day: DataFrame) -> DataFrame:
    """New rows of the day table: the time-dimension rows of the starts of
    ``days`` (a batch's calendar days, a bounded list) that it hasn't yet."""
    starts = spark.createDataFrame([(d,) for d in days], "day date").select(
        F.col("day").cast("timestamp_ntz").alias("event_timestamp"))
    return event_time_rows(starts.join(dim_day.select("event_timestamp"), "event_timestamp", "left_anti"))
