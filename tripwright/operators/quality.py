"""Quality and constraint checks.

Parquet tables carry no primary keys, range-partition bounds or VARCHAR
limits, so each declared constraint becomes a check that returns a small
report DataFrame (one aggregate pass over the table) or the offending rows
for a quarantine.  ``require`` turns a report into a raised error.
"""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.geo import point_is_valid
from ..functions.timeparts import ntz_literal
from ..schemas import CORRUPT, VARCHAR_LIMITS


class DataQualityError(AssertionError):
    pass


def check_non_empty(tables: dict[str, DataFrame], counted: bool = True) -> DataFrame:
    """(table_name, row_count, passed) for each table; passed = row_count > 0.
    Without ``counted`` a table is read up to its first row, and the count is
    1 or 0: as much as the check needs of a table that only grows."""
    parts = [(df if counted else df.limit(1)).agg(F.count(F.lit(1)).alias("row_count"))
               .select(F.lit(name).alias("table_name"), "row_count")
             for name, df in tables.items()]
    out = reduce(DataFrame.unionByName, parts)
    return out.withColumn("passed", F.col("row_count") > 0)


def require(report: DataFrame, flag: str = "passed") -> None:
    """Raise when any report row failed.  Reports are small (one row per
    table or column checked), so they are collected."""
    failed = [r.asDict() for r in report.where(~F.col(flag)).collect()]
    if failed:
        raise DataQualityError(f"data quality check failed: {failed}")


def group_total_report(fact: DataFrame, groups: dict[str, DataFrame]) -> DataFrame:
    """(table_name, row_count, group_total, passed) per group table: every trip
    of the fact is counted in it.  The fact is counted once."""
    n = fact.agg(F.count(F.lit(1)).alias("row_count"))
    totals = reduce(DataFrame.unionByName, [
        g.agg(F.coalesce(F.sum("number_of_trips"), F.lit(0)).alias("group_total"))
         .select(F.lit(t).alias("table_name"), "group_total") for t, g in groups.items()])
    return totals.join(n, F.lit(True)).select(     # a row per table, one row
        "table_name", "row_count", "group_total", (F.col("row_count") == F.col("group_total")).alias("passed"))


def key_report(df: DataFrame, keys: list[str], table: str) -> DataFrame:
    """(table_name, key_columns, row_count, distinct_keys, duplicate_keys,
    null_key_rows, passed) - a primary-key check (unique + not null).

    The group-by on the key is the unavoidable shuffle of a uniqueness check;
    its partial aggregation collapses repeated keys map-side.
    """
    any_null = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    g = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    rep = g.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).cast("bigint").alias("row_count"),
        F.count(F.lit(1)).cast("bigint").alias("distinct_keys"),
        F.coalesce(F.sum(F.when(F.col("_n") > 1, 1).otherwise(0)), F.lit(0)).cast("bigint")
         .alias("duplicate_keys"),
        F.coalesce(F.sum(F.when(any_null, F.col("_n")).otherwise(0)), F.lit(0)).cast("bigint")
         .alias("null_key_rows"),
    )
    return rep.select(
        F.lit(table).alias("table_name"), F.lit(",".join(keys)).alias("key_columns"),
        "row_count", "distinct_keys", "duplicate_keys", "null_key_rows",
        ((F.col("duplicate_keys") == 0) & (F.col("null_key_rows") == 0)).alias("passed"))


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Key values occurring more than once, with their count."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)


def outside_bounds(df: DataFrame, ts_col: str, start, end) -> Column:
    """True for rows outside the half-open month range ``[start, end)``."""
    t = F.col(ts_col)
    s = ntz_literal(_ts(start))
    e = ntz_literal(_ts(end))
    return t.isNull() | (t < s) | (t >= e)


def _ts(v):
    return v if isinstance(v, dt.datetime) else dt.datetime.fromisoformat(str(v))


def bounds_report(df: DataFrame, ts_col: str, start, end) -> DataFrame:
    """Per (year, month) of ``ts_col``: rows and rows outside ``[start, end)``."""
    bad = outside_bounds(df, ts_col, start, end)
    return (df.groupBy(F.year(ts_col).cast("int").alias("year"),
                       F.month(ts_col).cast("int").alias("month"))
              .agg(F.count(F.lit(1)).alias("row_count"),
                   F.sum(F.when(bad, 1).otherwise(0)).cast("bigint").alias("rows_outside")))


def text_length(c: str) -> Column:
    """Characters of a text without its trailing blanks, which don't count
    against a declared length."""
    return F.char_length(F.rtrim(F.col(c)))


def length_report(df: DataFrame, limits: dict[str, int] = VARCHAR_LIMITS) -> DataFrame:
    """(column_name, max_length, length_limit, rows_over_limit) per column,
    one aggregate pass for all columns."""
    cols = [c for c in limits if c in df.columns]
    aggs = []
    for c in cols:
        n = text_length(c)
        aggs += [F.max(n).alias(f"{c}__max"),
                 F.sum(F.when(n > limits[c], 1).otherwise(0)).cast("bigint").alias(f"{c}__over")]
    wide = df.agg(*aggs)
    rows = [F.struct(F.lit(c).alias("column_name"),
                     F.col(f"{c}__max").cast("int").alias("max_length"),
                     F.lit(limits[c]).alias("length_limit"),
                     F.coalesce(F.col(f"{c}__over"), F.lit(0)).alias("rows_over_limit"))
            for c in cols]
    return wide.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def malformed_reason(point_cols: tuple[str, ...] = ("origin_coord", "destination_coord"),
                     ts_col: str = "datetime",
                     limits: dict[str, int] = VARCHAR_LIMITS) -> Column:
    """NULL for a well-formed staged row, else the first failing field name
    (``<column>_length`` for text over its declared length).  NULL point
    text is allowed (it yields a NULL point); text that does not parse to two
    numbers is not."""
    reason = F.lit(None).cast("string")
    for c in reversed(point_cols):
        bad = F.col(c).isNotNull() & ~point_is_valid(c)
        reason = F.when(bad, F.lit(c)).otherwise(reason)
    for c in reversed(list(limits)):
        reason = F.when(text_length(c) > limits[c], F.lit(f"{c}_length")).otherwise(reason)
    return F.when(F.col(ts_col).isNull(), F.lit(ts_col)).otherwise(reason)


def enforce_lengths(df: DataFrame, limits: dict[str, int] = VARCHAR_LIMITS) -> DataFrame:
    """Same rows, but text longer than its declared length raises when the
    row is evaluated - in the pass that writes it, no extra scan.  Blanks at
    the end beyond that length are cut off instead."""
    cols = []
    for c in df.columns:
        if c in limits:
            too_long = text_length(c) > limits[c]
            cols.append(F.when(too_long, F.raise_error(F.lit(
                f"value too long for {c} (limit {limits[c]} characters)"))).when(
                F.char_length(F.col(c)) > limits[c], F.substring(F.col(c), 1, limits[c])).otherwise(F.col(c))
                .alias(c))
        else:
            cols.append(F.col(c))
    return df.select(*cols)


def split_malformed(stage: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good, bad) rows; bad rows carry a ``reason`` column for quarantine, and
    the original text of a line the reader could not split (``CORRUPT``)."""
    reason = malformed_reason()
    if CORRUPT in stage.columns:
        reason = F.when(F.col(CORRUPT).isNotNull(), F.lit("line")).otherwise(reason)
    tagged = stage.withColumn("reason", reason)
    good = tagged.where(F.col("reason").isNull()).drop("reason", CORRUPT)
    return enforce_lengths(good), tagged.where(F.col("reason").isNotNull())


def malformed_report(stage: DataFrame) -> DataFrame:
    """One row: total rows, malformed origin / destination / timestamp, NULL
    region / datasource (rows that can never reach the fact)."""
    def bad(c):
        return F.col(c).isNotNull() & ~point_is_valid(c)
    return stage.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.sum(F.when(bad("origin_coord"), 1).otherwise(0)).cast("bigint").alias("bad_origin"),
        F.sum(F.when(bad("destination_coord"), 1).otherwise(0)).cast("bigint").alias("bad_destination"),
        F.sum(F.when(F.col("datetime").isNull(), 1).otherwise(0)).cast("bigint").alias("null_datetime"),
        F.sum(F.when(F.col("region").isNull(), 1).otherwise(0)).cast("bigint").alias("null_region"),
        F.sum(F.when(F.col("datasource").isNull(), 1).otherwise(0)).cast("bigint").alias("null_datasource"),
    )

