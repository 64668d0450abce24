import datetime as dt

import pytest
from pyspark.sql import functions as F

from tripwright.sources import compaction as C
from tripwright.sources.tables import TablePaths, read_table, write_monthly

START = dt.datetime(2018, 5, 1)


@pytest.fixture()
def crowded(spark, scratch):
    """A month of 60 small appends, every tenth with late rows, and a quiet one."""
    paths = TablePaths(scratch)
    rows = [(START + dt.timedelta(hours=i), bytes([i]), i % 5, i % 3) for i in range(60)]
    schema = "event_timestamp timestamp_ntz, event_id binary, region_id int, datasource_id int"
    for i in range(60):
        batch = rows[i:i + 1] + ([(START + dt.timedelta(minutes=i), bytes([200]), 0, 0)] if i % 10 == 0 else [])
        write_monthly(spark.createDataFrame(batch, schema).withColumns(
            {c: F.lit(None).cast("struct<x:double,y:double>") for c in ("origin_coord", "destination_coord")}),
            "event_timestamp", paths.path("fact_trips"))
    quiet = spark.createDataFrame([(dt.datetime(2018, 6, 1), b"q", 1, 1)], schema).withColumns(
        {c: F.lit(None).cast("struct<x:double,y:double>") for c in ("origin_coord", "destination_coord")})
    write_monthly(quiet, "event_timestamp", paths.path("fact_trips"))
    return paths


def state(spark, paths):
    rows = sorted(map(tuple, read_table(spark, paths, "fact_trips").collect()), key=repr)
    return rows, {(r.year, r.month): r.files for r in C.month_files(spark, paths, "fact_trips").collect()}


def test_small_files_become_few_and_disjoint(spark, crowded):
    rows, files = state(spark, crowded)
    assert files[2018, 5] >= 60 and len(rows) == 67
    june = C.month_files(spark, crowded, "fact_trips").where("month = 6").first()
    assert C.compact_months(spark, crowded, "fact_trips", [(2018, 6)]) == []
    small = sum(r.bytes for r in C.month_files(spark, crowded, "fact_trips").where("month = 5").collect()) // 4
    assert C.compact_months(spark, crowded, "fact_trips", [(2018, 5), (2018, 6)], file_bytes=small) == [(2018, 5)]
    after, few = state(spark, crowded)
    assert after == rows and few[2018, 5] <= 6 and C.month_files(spark, crowded, "fact_trips").where("month = 6").first() == june
    spans = sorted((r.lo, r.hi) for r in read_table(spark, crowded, "fact_trips").groupBy(F.input_file_name()).agg(
        F.min("event_timestamp").alias("lo"), F.max("event_timestamp").alias("hi")).collect())
    assert all(a[1] < b[0] for a, b in zip(spans, spans[1:]))
    assert C.compact_months(spark, crowded, "fact_trips", file_bytes=small) == []      # nothing left to do


@pytest.mark.parametrize("step", ["before_swap", "after_delete"])
def test_a_swap_that_died_is_made_good(spark, crowded, monkeypatch, step):
    from tripwright.session import delete_path
    rows, _ = state(spark, crowded)

    def dies(*a, **k):
        if step == "after_delete":             # the month is gone, the new one not there yet
            delete_path(spark, f"{crowded.path('fact_trips')}/year=2018/month=5")
        raise RuntimeError("lost driver")

    with monkeypatch.context() as m:
        m.setattr(C, "write_monthly", dies)
        with pytest.raises(RuntimeError):
            C.compact_months(spark, crowded, "fact_trips")
    C.finish_compaction(spark, crowded, "fact_trips")
    after, files = state(spark, crowded)
    assert after == rows and files[2018, 5] < 20
