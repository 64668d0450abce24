"""Plan shape checks: pruning, pushdown, join strategies."""

import contextlib
import datetime as dt
import io

from pyspark.sql import functions as F


from tripwright.plans import analytics as A
from tripwright.plans.pipeline import Warehouse, run_pipeline
from tripwright.sources.adapter import stage_from_sf
from tripwright.sources.tables import TablePaths, month_predicate, write_monthly

SF = "/root/testdata/sf0.001"


def plan(df):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    return buf.getvalue()


def test_month_predicate_prunes_partitions(spark, scratch):
    rows = [(dt.datetime(2018, m, 3, 10, 0, 0), m) for m in range(1, 13)]
    df = spark.createDataFrame(rows, "event_timestamp timestamp_ntz, v int")
    write_monthly(df, "event_timestamp", scratch, mode="overwrite")
    back = spark.read.parquet(scratch)
    q = back.where(month_predicate("2018-05-01", "2018-06-01"))
    p = plan(q)
    assert "PartitionFilters: [" in p
    assert "year" in p.split("PartitionFilters: [")[1].split("]")[0]
    assert [r.v for r in q.collect()] == [5]
    files = q.inputFiles()
    assert files  # pruning shows in PartitionFilters; inputFiles ignores it


def test_monthly_files_are_few_and_disjoint(spark, scratch):
    start = dt.datetime(2018, 1, 1)
    rows = [(start + dt.timedelta(hours=3 * i),) for i in range(24 * 30 * 2)]           # six months
    rows += [(dt.datetime(2018, 3, 5) + dt.timedelta(seconds=i),) for i in range(4000)]   # a hot one
    df = spark.createDataFrame(rows, "event_timestamp timestamp_ntz").repartition(8)
    old = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    try:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        write_monthly(df, "event_timestamp", scratch, mode="overwrite")
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old)
    back = spark.read.parquet(scratch)
    assert back.count() == len(rows)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    spans = sorted((r.lo, r.hi, r.month) for r in back.groupBy(F.input_file_name().alias("f"), "month").agg(
        F.min("event_timestamp").alias("lo"), F.max("event_timestamp").alias("hi")).collect())
    assert len(spans) <= parts + 6
    assert all(a[1] < b[0] for a, b in zip(spans, spans[1:]))
    assert sum(m == 3 for *_, m in spans) >= 3                                          # the hot month is split


def test_check_position_pushes_box_filters(spark, scratch):
    paths = TablePaths(scratch)
    run_pipeline(spark, paths, stage_from_sf(spark, SF))
    wh = Warehouse(spark, paths)
    q = A.check_position(wh.fact_group_trips, wh.dim_region, 7.5, 50.5)
    p = plan(q)
    assert "LessThanOrEqual(box_coord.x0,7.5)" in p
    assert "BroadcastHashJoin" in p
    topk = A.region_trip_stats(wh.fact_trips).orderBy(F.col("number_of_trips").desc()).limit(2)
    assert "TakeOrderedAndProject" in plan(topk)
    top = A.latest_datasource_top(wh.fact_trips, wh.dim_region, wh.dim_datasource, 2)
    tp = plan(top)
    assert tp.count("Location: InMemoryFileIndex") == 3 and "TakeOrderedAndProject" in tp   # the fact once
    assert "NestedLoopJoin" not in plan(A.trip_origins_in_boxes(wh.fact_trips, wh.fact_group_trips))


def test_hot_user_is_split_by_aqe(spark, scratch):
    """Clicks and views (~40% of events) all from one user: AQE's skew join
    splits that user's shuffle partition across tasks; no row is lost."""
    from tripwright.sources.adapter import read_sf, stage_from_events
    sf = "/root/testdata/sf0.01"
    conf = {"spark.sql.autoBroadcastJoinThreshold": "3k",      # nation only
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "3k",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        ev = read_sf(spark, sf, "events")
        hot = ev.withColumn("user_id", F.when(F.col("event_type").isin("click", "view"), F.lit(7))
                            .otherwise(F.col("user_id")))
        hot.repartition(8).write.parquet(f"{scratch}/events")   # a multi-file input
        df = stage_from_events(spark.read.parquet(f"{scratch}/events"),
                               read_sf(spark, sf, "customer"), read_sf(spark, sf, "nation"))
        assert len(df.collect()) == ev.count()
        final = df._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin(skew=true)" in final
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_boxes_along_the_curve_are_skipped(spark, scratch, tmp_path):
    """A month of daily boxes of many places: laid in order of time every file
    holds boxes from everywhere, along the curve few can hold a probe."""
    import random

    import pyarrow.parquet as pq
    from tripwright.functions.geo import curve_position
    from tripwright.sources.tables import write_by_place
    rng = random.Random(4)
    rows = []
    for region in range(400):
        x, y = rng.uniform(-170, 170), rng.uniform(-80, 80)
        rows += [(dt.datetime(2018, 5, 1 + d), region, (x - 0.1, y - 0.1, x + 0.1, y + 0.1), 1) for d in range(28)]
    box = "struct<x0:double,y0:double,x1:double,y1:double>"
    df = spark.createDataFrame(rows, f"event_date timestamp_ntz, region_id int, box_coord {box}, number_of_trips long").repartition(8)
    keys = ("spark.sql.adaptive.coalescePartitions.enabled", "spark.sql.shuffle.partitions")
    old = [spark.conf.get(k) for k in keys]
    try:
        for k, v in zip(keys, ("false", "28")):
            spark.conf.set(k, v)
        write_by_place(df, "event_date", f"{scratch}/place")
        write_monthly(df, "event_date", f"{scratch}/time", mode="overwrite")
    finally:
        for k, v in zip(keys, old):
            spark.conf.set(k, v)

    def may_hold(folder, x, y):
        """Files whose statistics let the four pushed comparisons through."""
        n = 0
        for path in spark.read.parquet(folder).inputFiles():
            meta = pq.ParquetFile(path.removeprefix("file://")).metadata
            stats = {}
            for g in range(meta.num_row_groups):
                for c in range(meta.num_columns):
                    col = meta.row_group(g).column(c)
                    stats.setdefault(col.path_in_schema, []).append(col.statistics)
            n += any(a.min <= x and b.min <= y and c.max >= x and d.max >= y for a, b, c, d in zip(
                *(stats[f"box_coord.{k}"] for k in ("x0", "y0", "x1", "y1"))))
        return n

    files = len(spark.read.parquet(f"{scratch}/place").inputFiles())
    assert files >= 24 and len(spark.read.parquet(f"{scratch}/time").inputFiles()) >= 24
    read = [0, 0]
    for _, region, (x0, y0, _, _), _ in rows[::1400]:
        x, y = x0 + 0.1, y0 + 0.1
        read = [n + may_hold(f"{scratch}/{k}", x, y) for n, k in zip(read, ("place", "time"))]
        from tripwright.functions.geo import box_contains
        hits = [spark.read.parquet(f"{scratch}/{k}").where(box_contains("box_coord", x, y)) for k in ("place", "time")]
        assert sorted(tuple(r) for r in hits[0].collect()) == sorted(tuple(r) for r in hits[1].collect()) != []
    assert 4 * read[0] < read[1]
    odd = spark.createDataFrame([(None, 1.0), (float("nan"), 1.0), (1e300, -1e300), (float("inf"), 0.0), (0.0, 0.0)], "x double, y double")
    assert all(0 <= r.p < 1 << 32 for r in odd.select(curve_position("x", "y").alias("p")).collect())
