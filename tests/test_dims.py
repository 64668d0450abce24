from pyspark.sql import Window
from pyspark.sql import functions as F

from tripwright import schemas
from tripwright.operators.dims import event_time_members, fill_event_time, upsert_dim
from tripwright.operators.ids import dense_ids
from helpers import stage_df, ts

P = "POINT (1 1)"


def test_upsert_continues_ids_and_keeps_old(spark):
    empty = spark.createDataFrame([], schemas.DIM_REGION)
    b1 = stage_df(spark, [("Vienna", P, P, "2018-05-01 01:00:00", "a"),
                          ("Lisbon", P, P, "2018-05-01 02:00:00", "a")])
    d1 = upsert_dim(b1, empty, "region", "region_id")
    assert sorted(map(tuple, d1.collect())) == [(1, "Lisbon"), (2, "Vienna")]
    b2 = stage_df(spark, [("Vienna", P, P, "2018-05-02 01:00:00", "a"),
                          ("Bergen", P, P, "2018-05-02 02:00:00", "a"),
                          ("Amsterdam", P, P, "2018-05-02 03:00:00", "a")])
    d2 = upsert_dim(b2, d1, "region", "region_id")
    assert sorted(map(tuple, d2.collect())) == [(3, "Amsterdam"), (4, "Bergen")]


def test_null_region_never_becomes_a_member(spark):
    empty = spark.createDataFrame([], schemas.DIM_REGION)
    b = stage_df(spark, [(None, P, P, "2018-05-01 01:00:00", "a"),
                         ("Vienna", P, P, "2018-05-01 02:00:00", "a")])
    d = upsert_dim(b, empty, "region", "region_id")
    assert [tuple(r) for r in d.collect()] == [(1, "Vienna")]
    again = upsert_dim(b, d, "region", "region_id")
    assert again.count() == 0


def test_dense_ids_range_path_equals_row_number(spark):
    df = spark.range(0, 5000).select((F.col("id") * 7919 % 100003).cast("string").alias("k")).distinct()
    got = dense_ids(df, ["k"], "id", start=10, num_partitions=7)
    want = df.select((F.row_number().over(Window.orderBy("k")) + 10).cast("int").alias("id"), "k")
    assert got.count() == df.count()
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_event_time_members_has_midnight_once(spark):
    b = stage_df(spark, [("r", P, P, "2018-05-01 00:00:00", "a"),
                         ("r", P, P, "2018-05-01 07:00:00", "a")])
    got = sorted(r[0] for r in event_time_members(b).collect())
    assert got == [ts("2018-05-01 00:00:00"), ts("2018-05-01 07:00:00")]


def test_fill_event_time_only_new(spark):
    b1 = stage_df(spark, [("r", P, P, "2018-05-01 07:00:00", "a")])
    dim = fill_event_time(b1, spark.createDataFrame([], schemas.DIM_EVENT_TIME))
    b2 = stage_df(spark, [("r", P, P, "2018-05-01 07:00:00", "a"),
                          ("r", P, P, "2018-05-02 08:00:00", "a")])
    new = fill_event_time(b2, dim, months=[(2018, 5)])
    got = sorted(r["event_timestamp"] for r in new.collect())
    assert got == [ts("2018-05-02 00:00:00"), ts("2018-05-02 08:00:00")]
    row = new.where(F.col("hour") == 8).first()
    assert (row["day"], row["month"], row["year"], row["weekday"]) == (2, 5, 2018, 3)


def test_dense_ids_use_no_single_partition(spark):
    df = spark.createDataFrame([(c,) for c in "dbca"], "k string")
    got = dense_ids(df, ["k"], "id", start=3)
    assert "SinglePartition" not in got._jdf.queryExecution().toString()
    assert sorted(map(tuple, got.collect())) == [(4, "a"), (5, "b"), (6, "c"), (7, "d")]
    assert dense_ids(df.where("false"), ["k"], "id").collect() == []
