import datetime as dt

import pytest
from pyspark.sql import functions as F

from tripwright.operators import sketch as K
from tripwright.operators.facts import insert_if_absent
from tripwright.plans.pipeline import PipelineOptions, Warehouse, run_pipeline
from tripwright.plans.scenarios import calendar_batch
from tripwright.sources.tables import TablePaths

KEYS = ["event_timestamp", "event_id"]


def keys(spark, low, high):
    start = F.lit(dt.datetime(2018, 5, 1)).cast("timestamp_ntz")
    n = spark.range(low, high, numPartitions=5)
    return n.select((start + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), (F.col("id") % 977).cast("decimal(18,6)")))
                    .alias("event_timestamp"), F.unhex(F.md5(F.col("id").cast("string"))).alias("event_id"))


def test_same_rows_and_few_keys(spark):
    table, batch = keys(spark, 0, 20_000), keys(spark, 19_500, 20_300)
    few = K.may_match(table, KEYS, batch, 800).cache()
    assert 500 <= few.count() < 1200                # 500 are there, and some by chance
    got = insert_if_absent(batch, few, dedupe=False)
    want = insert_if_absent(batch, table, dedupe=False)
    assert got.count() == 300 and got.exceptAll(want).count() == 0
    assert K.may_match(table, KEYS, batch.where("false"), 0).count() == 0
    odd = batch.limit(1).union(batch.limit(1).select(F.lit(None).cast("timestamp_ntz"), "event_id"))
    assert K.may_match(odd, KEYS, odd, 2).count() == 2


def test_size_is_bounded(spark):
    assert K.bits_for(0) == K.LEAST_BITS and K.bits_for(10 ** 6) == 1 << 24 and K.bits_for(10 ** 9) is None
    table = keys(spark, 0, 50)
    assert K.may_match(table, KEYS, table.limit(3), 10 ** 9).count() == 50


@pytest.mark.parametrize("sketch_bytes", [0, None])
def test_load_with_and_without(spark, scratch, sketch_bytes):
    paths, sf = TablePaths(scratch), "/root/testdata/sf0.001"
    for name in ("A", "B", "A"):
        run_pipeline(spark, paths, calendar_batch(spark, sf, name), PipelineOptions(sketch_bytes=sketch_bytes))
    wh = Warehouse(spark, paths)
    a, b = (calendar_batch(spark, sf, n) for n in ("A", "B"))
    assert wh.fact_trips.count() == a.union(b).distinct().count()
    assert wh.fact_trips.select(*KEYS).distinct().count() == wh.fact_trips.count()
