import datetime as dt

from pyspark.sql import functions as F

from tripwright.plans.pipeline import run_pipeline
from tripwright.sources.csv_trips import read_trips
from tripwright.sources.ledger import new_files, record_files
from tripwright.sources.sql import register_catalog, register_views, run_query
from tripwright.sources.tables import TablePaths, days_filter, month_predicate
from helpers import write_csv

ROWS = [
    ["Vienna", "POINT (7.60 45.00)", "POINT (7.70 45.10)", "2018-05-05 08:00:00", "city_hop"],
    ["Lisbon", "POINT (14.40 50.05)", "POINT (14.50 50.10)", "2018-05-06 07:00:00", "bike_net"],
    ["Lisbon", "POINT (14.41 50.06)", "POINT (14.51 50.11)", "2018-06-01 07:00:00", "city_hop"],
]


def test_sql_over_catalog_tables(spark, scratch, tmp_path):
    p = tmp_path / "t.csv"
    write_csv(p, ROWS)
    paths = TablePaths(scratch)
    run_pipeline(spark, paths, read_trips(spark, str(p)))
    register_catalog(spark, paths)
    got = run_query(spark, "SELECT count_if(hour(event_timestamp) < :h) AS early FROM trips.fact_trips", {"h": 8})
    assert got.first().early == 2
    months = run_query(spark, "SELECT DISTINCT year, month FROM trips.fact_trips ORDER BY 1, 2")
    assert [tuple(r) for r in months.collect()] == [(2018, 5), (2018, 6)]
    names = register_views(spark, paths, prefix="v_")
    assert "v_fact_group_trips" in names
    assert spark.sql("SELECT count(*) FROM v_fact_group_trips").first()[0] == 3


def test_ledger_skips_seen_files(spark, scratch, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    write_csv(src / "a.csv", ROWS[:1])
    write_csv(src / "b.csv", ROWS[1:])
    ledger = f"{scratch}/ledger"
    first = new_files(spark, str(src / "*.csv"), ledger)
    assert first.count() == 2
    record_files(first, ledger, "batch-1")
    assert new_files(spark, str(src / "*.csv"), ledger).count() == 0
    write_csv(src / "c.csv", ROWS[:1])
    fresh = [r.path for r in new_files(spark, str(src / "*.csv"), ledger).collect()]
    assert len(fresh) == 1 and fresh[0].endswith("c.csv")


def test_day_and_month_filters(spark):
    rows = [(dt.datetime(2018, 5, d, 12, 0, 0),) for d in (1, 2, 3, 7, 31)] + \
           [(dt.datetime(2018, 6, 1, 0, 0, 0),)]
    df = spark.createDataFrame(rows, "event_timestamp timestamp_ntz") \
        .withColumn("year", F.year("event_timestamp")).withColumn("month", F.month("event_timestamp"))
    days = [dt.date(2018, 5, 1), dt.date(2018, 5, 2), dt.date(2018, 5, 31), dt.date(2018, 6, 1)]
    got = sorted(r[0].day for r in df.where(days_filter(days, "event_timestamp")).collect())
    assert got == [1, 1, 2, 31]
    win = df.where(month_predicate("2018-05-02", "2018-05-31")).count()
    assert win == 3


def test_identifier_parameter(spark, scratch, tmp_path):
    p = tmp_path / "t.csv"
    write_csv(p, ROWS)
    paths = TablePaths(scratch)
    run_pipeline(spark, paths, read_trips(spark, str(p)))
    register_catalog(spark, paths)
    n = run_query(spark, "SELECT count(*) AS n FROM IDENTIFIER(:t)", {"t": "trips.dim_region"})
    assert n.first().n == 2


def test_sql_text_matches_dataframe_queries(spark, scratch, tmp_path):
    from tripwright.plans import analytics as A
    from tripwright.plans import sql_text as T
    from tripwright.plans.pipeline import Warehouse
    rows = ROWS + [["Vienna", "POINT (7.61 45.01)", "POINT (7.62 45.02)", "2018-05-05 09:00:00", "bike_net"]]
    p = tmp_path / "t.csv"
    write_csv(p, rows)
    paths = TablePaths(scratch)
    run_pipeline(spark, paths, read_trips(spark, str(p)))
    register_catalog(spark, paths)
    wh = Warehouse(spark, paths)

    def same(a, b):
        assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))

    same(run_query(spark, T.REGIONS_OF_DATASOURCE, {"datasource": "city_hop"}),
         A.regions_of_datasource(wh.fact_trips, wh.dim_region, wh.dim_datasource, "city_hop"))
    same(run_query(spark, T.LATEST_DATASOURCE_TOP, {"k": 2}),
         A.latest_datasource_top(wh.fact_trips, wh.dim_region, wh.dim_datasource, 2))
    same(run_query(spark, T.WEEKLY_AVG_TRIPS),
         A.weekly_avg_trips(wh.fact_group_trips, wh.dim_region, wh.dim_day))
    same(run_query(spark, T.CHECK_POSITION, {"x": 7.60, "y": 45.00}),
         A.check_position(wh.fact_group_trips, wh.dim_region, 7.60, 45.00))
    same(run_query(spark, T.LIST_REGIONS), wh.dim_region)
    last = run_query(spark, T.LAST_LOG_EVENT).first()
    assert (last.event, last.event_type) == ("data_quality", "end")


CSV = '''region,origin_coord,destination_coord,datetime,datasource
"St ""Jo""",POINT (1 1),POINT (2 2),2018-05-01 08:00:00,a
"St ""Jo"", X",POINT (1 1),POINT (2 2),2018-05-01 08:00:00.25,"a\\"
'''


def test_csv_dialect(spark, tmp_path):
    (tmp_path / "q.csv").write_text(CSV)
    got = [(r.region, r.datetime.microsecond, r.datasource) for r in read_trips(spark, str(tmp_path / "q.csv")).collect()]
    assert got == [('St "Jo"', 0, "a"), ('St "Jo", X', 250000, "a\\")]
    (tmp_path / "n.csv").write_text(CSV + '"two\nlines",POINT (1 1),POINT (2 2),2018-05-01 08:00:00,a\n')
    assert [r.region for r in read_trips(spark, str(tmp_path / "n.csv"), multiline=True).collect()][-1] == "two\nlines"


def test_lenient_lines_keep_their_text(spark, scratch, tmp_path):
    from tripwright.plans.pipeline import PipelineOptions, Warehouse
    bad = ["V,POINT (1 1),POINT (2 2),noon,a", "V,POINT (1 1),POINT (2 2),2018-05-01 08:00:00,a,sixth"]
    (tmp_path / "b.csv").write_text(CSV + "\n".join(bad) + "\n")
    paths = TablePaths(scratch)
    for _ in range(2):     # the same batch again replaces its folders
        run_pipeline(spark, paths, read_trips(spark, str(tmp_path / "b.csv"), strict=False),
                     PipelineOptions(strict=False, batch_id="b"))
    q = spark.read.parquet(f"{scratch}/trips_stage/quarantine")
    assert sorted(r["_corrupt_record"] for r in q.collect()) == sorted(bad)
    assert Warehouse(spark, paths).fact_trips.count() == 2


def test_new_files_are_loaded_once(spark, scratch, tmp_path):
    from tripwright.plans.pipeline import Warehouse, ingest_new_files
    src = tmp_path / "in files"
    src.mkdir()
    write_csv(src / "a.csv", ROWS[:1])
    paths = TablePaths(scratch)
    assert ingest_new_files(spark, paths, str(src / "*.csv")) == 1
    write_csv(src / "b.csv", ROWS[1:])
    assert ingest_new_files(spark, paths, str(src / "*.csv")) == 1
    assert ingest_new_files(spark, paths, str(src / "*.csv")) == 0
    assert Warehouse(spark, paths).fact_trips.count() == 3


def test_batches_are_cut_by_bytes_and_files(spark):
    from tripwright.sources.ledger import deal_batches
    start = dt.datetime(2018, 5, 1)
    rows = [(f"f{i:04d}", 10 + i % 7, start + dt.timedelta(minutes=i // 3)) for i in range(500)]
    files = spark.createDataFrame(rows, "path string, length long, modificationTime timestamp")
    for size, number in ((100, 10_000), (10 ** 9, 7), (60, 5), (1, 1)):
        got = sorted(deal_batches(files, size, number).collect(), key=lambda r: (r.modificationTime, r.path))
        assert [r.path for r in got] == [r[0] for r in sorted(rows, key=lambda r: (r[2], r[0]))]
        assert all(a.batch <= b.batch for a, b in zip(got, got[1:]))
        for k in {r.batch for r in got}:
            mine = [r.length for r in got if r.batch == k]
            assert len(mine) <= number and sum(mine[:-1]) < size
    assert deal_batches(files.where("false")).collect() == []


def test_a_plan_goes_on_after_a_restart(spark, scratch, tmp_path, monkeypatch):
    """Batches of one file; the run dies in the second, a file comes in, and the
    next run does the rest with the batch ids of the first plan."""
    import tripwright.plans.pipeline as P
    src = tmp_path / "many"
    src.mkdir()
    for i in range(3):
        write_csv(src / f"{i}.csv", [["Vienna", "POINT (1 1)", "POINT (2 2)", f"2018-05-0{i + 1} 08:00:00", "a"]] * 2)
    paths, ran = TablePaths(scratch), []
    real = P.update_facts

    def dies(spark, paths, opts, days):
        real(spark, paths, opts, days)
        ran.append(opts.batch_id)
        if len(ran) == 2:
            raise RuntimeError("lost driver")

    opts = P.PipelineOptions(stage_mode="append")
    with monkeypatch.context() as m:
        m.setattr(P, "update_facts", dies)
        try:
            P.ingest_new_files(spark, paths, str(src / "*.csv"), opts, batch_files=1)
            raise AssertionError("it should have died")
        except RuntimeError:
            pass
        write_csv(src / "late.csv", ROWS[:1])
        assert P.ingest_new_files(spark, paths, str(src / "*.csv"), opts, batch_files=1) == 3     # two of the plan, one new
    assert ran[2] == ran[1] and len(set(ran)) == 4
    wh = P.Warehouse(spark, paths)
    assert wh.fact_trips.count() == 4 and wh.trips.count() == 7
    assert P.ingest_new_files(spark, paths, str(src / "*.csv"), opts) == 0
