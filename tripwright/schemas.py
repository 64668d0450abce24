"""Declared schemas of every table (no inference anywhere)."""

from __future__ import annotations

from pyspark.sql import types as T

POINT = T.StructType([
    T.StructField("x", T.DoubleType()),   # longitude
    T.StructField("y", T.DoubleType()),   # latitude
])

BOX = T.StructType([
    T.StructField("x0", T.DoubleType()),
    T.StructField("y0", T.DoubleType()),
    T.StructField("x1", T.DoubleType()),
    T.StructField("y1", T.DoubleType()),
])

# Staging table: the five text/timestamp columns of a trips file, positional.
TRIPS = T.StructType([
    T.StructField("region", T.StringType()),
    T.StructField("origin_coord", T.StringType()),
    T.StructField("destination_coord", T.StringType()),
    T.StructField("datetime", T.TimestampNTZType()),
    T.StructField("datasource", T.StringType()),
])

# Declared VARCHAR lengths of the staging and dimension columns.
VARCHAR_LIMITS = {
    "region": 50,
    "origin_coord": 255,
    "destination_coord": 255,
    "datasource": 50,
}

DIM_REGION = T.StructType([
    T.StructField("region_id", T.IntegerType()),
    T.StructField("region", T.StringType()),
])

DIM_DATASOURCE = T.StructType([
    T.StructField("datasource_id", T.IntegerType()),
    T.StructField("datasource", T.StringType()),
])

DIM_EVENT_TIME = T.StructType([
    T.StructField("event_timestamp", T.TimestampNTZType()),
    T.StructField("hour", T.IntegerType()),
    T.StructField("day", T.IntegerType()),
    T.StructField("week", T.IntegerType()),
    T.StructField("month", T.IntegerType()),
    T.StructField("year", T.IntegerType()),
    T.StructField("weekday", T.IntegerType()),
])

FACT_DELTA = T.StructType([
    T.StructField("event_timestamp", T.TimestampNTZType()),
    T.StructField("event_id", T.BinaryType()),
    T.StructField("region_id", T.IntegerType()),
    T.StructField("datasource_id", T.IntegerType()),
    T.StructField("origin_coord", POINT),
    T.StructField("destination_coord", POINT),
])

# The fact adds the month partition columns (derived from event_timestamp).
FACT_TRIPS = T.StructType(FACT_DELTA.fields + [
    T.StructField("year", T.IntegerType()),
    T.StructField("month", T.IntegerType()),
])

FACT_GROUP_TRIPS = T.StructType([
    T.StructField("event_date", T.TimestampNTZType()),
    T.StructField("region_id", T.IntegerType()),
    T.StructField("box_coord", BOX),
    T.StructField("number_of_trips", T.LongType()),
    T.StructField("year", T.IntegerType()),
    T.StructField("month", T.IntegerType()),
])

TRIPS_LOG = T.StructType([
    T.StructField("log_id", T.IntegerType()),
    T.StructField("log_name", T.StringType()),
    T.StructField("pipeline_version_instance", T.StringType()),
    T.StructField("event", T.StringType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("execution_date_time", T.TimestampNTZType()),
    T.StructField("duration_sec", T.DoubleType()),
])

# Column with the original text of a line that a lenient reader could not split.
CORRUPT = "_corrupt_record"

# What the daily group rows of both kinds follow from, and what a batch can be
# merged into: the extremes of the trips' lower and upper corners and their number.
GROUP_STATE = T.StructType([
    T.StructField("event_date", T.TimestampNTZType()),
    T.StructField("region_id", T.IntegerType()),
    T.StructField("min_lx", T.DoubleType()),
    T.StructField("min_ly", T.DoubleType()),
    T.StructField("max_lx", T.DoubleType()),
    T.StructField("max_ly", T.DoubleType()),
    T.StructField("max_hx", T.DoubleType()),
    T.StructField("max_hy", T.DoubleType()),
    T.StructField("number_of_trips", T.LongType()),
    T.StructField("year", T.IntegerType()),
    T.StructField("month", T.IntegerType()),
])

# Primary keys as declared for each table (checked by quality.key_report).
PRIMARY_KEYS = {
    "dim_region": ["region_id"],
    "dim_datasource": ["datasource_id"],
    "dim_event_time": ["event_timestamp"],
    "fact_delta_trips": ["event_timestamp", "event_id"],
    "fact_trips": ["event_timestamp", "event_id"],
    "fact_group_trips": ["event_date", "region_id"],
    "trips_log": ["log_id"],
}

# Month-partition columns of the partitioned tables.
PARTITION_COLUMNS = ["year", "month"]
