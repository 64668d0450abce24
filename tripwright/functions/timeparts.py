"""Timestamp helpers (all on ``timestamp_ntz``)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Output text patterns.  The "as written" pattern reproduces a
# query that asked for 'HH:mm:ss' in a dialect where HH is the 12-hour clock
# and mm the month.
DAY_PATTERN = "yyyy-MM-dd"
TIMESTAMP_PATTERN = "yyyy-MM-dd HH:mm:ss"
TIMESTAMP_PATTERN_AS_WRITTEN = "yyyy-MM-dd hh:MM:ss"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def day_start(ts) -> Column:
    """Midnight of the day, still ``timestamp_ntz`` (date_trunc would yield a
    zoned timestamp)."""
    return _col(ts).cast("date").cast("timestamp_ntz")


def iso_weekday(ts) -> Column:
    """Monday = 1 ... Sunday = 7."""
    return F.extract(F.lit("DAYOFWEEK_ISO"), _col(ts)).cast("int")


def event_time_parts(ts) -> list[Column]:
    """hour, day, ISO week, month, calendar year and ISO weekday columns."""
    t = _col(ts)
    return [
        F.hour(t).cast("int").alias("hour"),
        F.dayofmonth(t).cast("int").alias("day"),
        F.weekofyear(t).cast("int").alias("week"),
        F.month(t).cast("int").alias("month"),
        F.year(t).cast("int").alias("year"),
        iso_weekday(t).alias("weekday"),
    ]


def ntz_literal(value) -> Column:
    """A ``timestamp_ntz`` literal built from text, so neither the Python
    process's zone nor the session zone can shift it."""
    text = value.isoformat(sep=" ") if hasattr(value, "isoformat") else str(value)
    return F.lit(text).cast("timestamp_ntz")


def format_day(ts) -> Column:
    """``yyyy-MM-dd`` of a timestamp_ntz, read off the value itself
    (``date_format`` would pass through the session zone)."""
    return _col(ts).cast("date").cast("string")


def format_timestamp(ts, as_written: bool = False) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` (24-hour clock, minutes) of a timestamp_ntz.

    ``as_written`` gives ``yyyy-MM-dd hh:MM:ss``: 12-hour clock and the
    *month* where minutes were meant.  Both are composed from the value's
    own fields, independent of the session time zone.
    """
    t = _col(ts)
    if not as_written:
        return F.substring(t.cast("string"), 1, 19)
    hour12 = (F.hour(t) + 11) % 12 + 1
    return F.format_string("%s %02d:%02d:%02d", format_day(t), hour12, F.month(t), F.second(t))

