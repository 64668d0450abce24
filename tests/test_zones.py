import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tripwright.operators import zones as Z
from tripwright.operators.quality import key_report
from tripwright.sources.tables import write_monthly

KEYS = ["event_timestamp", "event_id"]
SCHEMA = "event_timestamp timestamp_ntz, event_id binary, v int"


def batch(day, n, seed, per_time=3):
    rng = random.Random(seed)
    return [(dt.datetime(2018, 5, day) + dt.timedelta(minutes=i // per_time), rng.randbytes(16), i) for i in range(n)]


@pytest.fixture()
def table(spark, scratch):
    """Days written one after the other, and late rows that reach over two of them."""
    for day in (1, 2, 3):
        write_monthly(spark.createDataFrame(batch(day, 400, day), SCHEMA).repartition(4), "event_timestamp", scratch)
    late = [(dt.datetime(2018, 5, 2, 5), b"late", 0), (dt.datetime(2018, 5, 3, 1), b"later", 0)]
    write_monthly(spark.createDataFrame(late, SCHEMA), "event_timestamp", scratch)
    return scratch


def same(spark, path):
    df = spark.read.parquet(path)
    got, want = Z.zone_key_report(df, "event_timestamp", KEYS, "t").first(), key_report(df, KEYS, "t").first()
    assert got.asDict() == want.asDict()
    return got


def test_whole_table_without_a_shuffle_of_it(spark, table):
    assert same(spark, table).passed
    df = spark.read.parquet(table)
    spans = Z.zones(df, "event_timestamp").collect()
    assert len(spans) >= 4 and all(r.in_order for r in spans)
    lo, hi = Z.shared_times(Z.zones(df, "event_timestamp"))
    t = F.unix_micros(F.col("event_timestamp").cast("timestamp"))
    shared = df.where(" or ".join(f"unix_micros(cast(event_timestamp as timestamp)) between {a} and {b}" for a, b in zip(lo, hi)))
    assert 0 < shared.select(t).count() < 0.6 * df.count()


def test_planted_repeats_and_nulls(spark, table):
    df = spark.read.parquet(table)
    rows = [tuple(r)[:3] for r in df.where("v in (7, 200)").collect()]
    write_monthly(spark.createDataFrame(rows[:2], SCHEMA), "event_timestamp", table)          # across files
    assert same(spark, table).duplicate_keys == 2
    twice = batch(9, 50, 9)
    write_monthly(spark.createDataFrame(twice + twice[20:23] + twice[20:21], SCHEMA).coalesce(1), "event_timestamp", table)   # inside one
    assert same(spark, table).duplicate_keys == 5
    odd = [(dt.datetime(2018, 5, 20), None, 1), (dt.datetime(2018, 5, 20), None, 2), (None, b"x", 3), (None, None, 4)]
    write_monthly(spark.createDataFrame(odd, SCHEMA), "event_timestamp", table)
    got = same(spark, table)
    assert not got.passed and got.null_key_rows == 4


def test_unsorted_files_and_an_empty_table(spark, scratch):
    rows = batch(1, 200, 1)
    random.Random(2).shuffle(rows)
    df = spark.createDataFrame(rows + rows[:5], SCHEMA).repartition(3)
    df.write.parquet(f"{scratch}/unsorted")
    assert same(spark, f"{scratch}/unsorted").duplicate_keys == 5
    df.where("false").write.parquet(f"{scratch}/none")
    assert same(spark, f"{scratch}/none").row_count == 0
