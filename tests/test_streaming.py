import os

from tripwright.plans.pipeline import Warehouse
from tripwright.sources.tables import TablePaths
from tripwright.streaming.ingest import daily_counts, ingest_stream, trips_file_stream
from helpers import stage_df, write_csv


def rows(day, n, region="Vienna"):
    return [[region, f"POINT (7.{i} 45.{i})", "POINT (7.5 45.5)", f"2018-05-{day:02d} 1{i % 10}:00:00",
             "app"] for i in range(n)]


def test_ingest_stream_picks_up_new_files_only(spark, scratch, tmp_path):
    src = tmp_path / "incoming"
    src.mkdir()
    write_csv(src / "a.csv", rows(1, 3))
    paths = TablePaths(scratch)
    ck = f"{scratch}/_checkpoint"
    ingest_stream(trips_file_stream(spark, str(src)), paths, ck).awaitTermination()
    wh = Warehouse(spark, paths)
    assert wh.fact_trips.count() == 3
    # a second file arrives: one overlapping trip, two new ones
    write_csv(src / "b.csv", rows(1, 1) + rows(2, 2))
    ingest_stream(trips_file_stream(spark, str(src)), paths, ck).awaitTermination()
    assert wh.fact_trips.count() == 5
    assert wh.fact_group_trips.count() == 2


def test_daily_counts_close_with_watermark(spark, scratch, tmp_path):
    src = tmp_path / "days"
    src.mkdir()
    write_csv(src / "1.csv", rows(1, 3) + rows(2, 2, "Lisbon"))
    write_csv(src / "2.csv", rows(5, 1))
    got = []
    q = (daily_counts(trips_file_stream(spark, str(src), max_files_per_trigger=1), delay="1 day")
         .writeStream.outputMode("append")
         .foreachBatch(lambda df, e: got.extend(tuple(r) for r in df.collect()))
         .option("checkpointLocation", f"{scratch}/_ck")
         .trigger(availableNow=True).start())
    q.awaitTermination()
    closed = {(str(r[0].date()), r[2]): r[3] for r in got}
    # days 1 and 2 are closed by the watermark (day 5 - 1 day); day 5 stays open
    assert closed == {("2018-05-01", "Vienna"): 3, ("2018-05-02", "Lisbon"): 2}


def test_write_deduplicated_across_batches(spark, scratch, tmp_path):
    from tripwright.streaming.ingest import write_deduplicated
    src = tmp_path / "redeliver"
    src.mkdir()
    write_csv(src / "1.csv", rows(1, 4) * 3)          # copies inside one batch
    write_csv(src / "2.csv", rows(1, 2) + rows(3, 2))  # copies across batches
    out = f"{scratch}/dedup"
    q = write_deduplicated(trips_file_stream(spark, str(src), max_files_per_trigger=1), out,
                           f"{scratch}/_ck")
    q.awaitTermination()
    df = spark.read.parquet(out)
    assert df.count() == 6 and df.distinct().count() == 6


def test_hourly_counts(spark, scratch, tmp_path):
    src = tmp_path / "hours"
    src.mkdir()
    write_csv(src / "1.csv", [["Vienna", "POINT (1 1)", "POINT (2 2)", "2018-05-01 10:05:00", "a"],
                              ["Vienna", "POINT (1 1)", "POINT (2 3)", "2018-05-01 10:55:00", "a"],
                              ["Vienna", "POINT (1 1)", "POINT (2 4)", "2018-05-01 11:10:00", "a"]])
    write_csv(src / "2.csv", [["Vienna", "POINT (1 1)", "POINT (2 2)", "2018-05-01 14:00:00", "a"]])
    got = []
    q = (daily_counts(trips_file_stream(spark, str(src), max_files_per_trigger=1), delay="1 hour",
                      hourly=True)
         .writeStream.outputMode("append")
         .foreachBatch(lambda df, e: got.extend(tuple(r) for r in df.collect()))
         .option("checkpointLocation", f"{scratch}/_ck").trigger(availableNow=True).start())
    q.awaitTermination()
    assert sorted((r[0].hour, r[3]) for r in got) == [(10, 2), (11, 1)]


def test_daily_windows_ignore_session_time_zone(spark, scratch, tmp_path):
    src = tmp_path / "tz"
    src.mkdir()
    write_csv(src / "1.csv", rows(1, 3) + rows(2, 2, "Lisbon"))
    write_csv(src / "2.csv", rows(5, 1))
    old = spark.conf.get("spark.sql.session.timeZone")
    got = []
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        q = (daily_counts(trips_file_stream(spark, str(src), max_files_per_trigger=1), delay="1 day")
             .writeStream.outputMode("append")
             .foreachBatch(lambda df, e: got.extend(tuple(r) for r in df.collect()))
             .option("checkpointLocation", f"{scratch}/_ck").trigger(availableNow=True).start())
        q.awaitTermination()
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert sorted((str(r[0]), r[2], r[3]) for r in got) == [
        ("2018-05-01 00:00:00", "Vienna", 3), ("2018-05-02 00:00:00", "Lisbon", 2)]


def test_nulls_are_written_once(spark, scratch):
    from tripwright.plans.scenarios import delivery_files
    from tripwright.streaming.ingest import write_deduplicated
    from helpers import stage_df
    two = stage_df(spark, [("Vienna", "POINT (1 1)", None, "2018-05-01 10:00:00", "a"),
                           (None, None, None, None, None), ("Vienna", "POINT (1 1)", "POINT (2 2)", "2018-05-01 10:00:00", "a")])
    folder = delivery_files(spark, [two, two, two], f"{scratch}/files", 1)
    write_deduplicated(trips_file_stream(spark, folder, "parquet", 1), f"{scratch}/out", f"{scratch}/_ck").awaitTermination()
    assert spark.read.parquet(f"{scratch}/out").count() == 3


def test_all_windows_without_delay(spark, scratch, tmp_path):
    from tripwright.streaming.ingest import read_daily_counts, write_daily_counts
    src = tmp_path / "late"
    src.mkdir()
    write_csv(src / "1.csv", rows(20, 1))
    write_csv(src / "2.csv", rows(1, 3) + rows(2, 2, "Lisbon"))
    out = f"{scratch}/counts"
    stream = trips_file_stream(spark, str(src), max_files_per_trigger=1)
    write_daily_counts(stream, out, f"{scratch}/_ck").awaitTermination()
    got = {(r.window_start.day, r.region): r.number_of_trips for r in read_daily_counts(spark, out).collect()}
    assert got == {(20, "Vienna"): 1, (1, "Vienna"): 3, (2, "Lisbon"): 2}


def test_bad_lines_go_to_quarantine_and_the_stream_goes_on(spark, scratch, tmp_path, monkeypatch):
    import pytest
    import tripwright.plans.pipeline as P
    src = tmp_path / "dirty"
    src.mkdir()
    write_csv(src / "1.csv", rows(1, 2) + [["V", "POINT (1 1)", "POINT (2 2)", "noon", "a"], ["V", "too few"]])
    write_csv(src / "2.csv", rows(2, 1) + [["V", "POINT (1)", "POINT (2 2)", "2018-05-02 10:00:00", "a"]])
    write_csv(src / "3.csv", rows(3, 1) + [["x" * 51, "POINT (1 1)", "POINT (2 2)", "2018-05-03 10:00:00", "a"]])
    paths, ck, opts = TablePaths(scratch), f"{scratch}/_checkpoint", P.PipelineOptions(strict=False)
    real, calls = P.check_batch, []

    def dies_once(*a, **k):
        calls.append(1)
        if len(calls) == 2:
            raise RuntimeError("lost driver")
        return real(*a, **k)

    def stream():
        return trips_file_stream(spark, str(src), max_files_per_trigger=1, strict=False)

    monkeypatch.setattr(P, "check_batch", dies_once)
    with pytest.raises(Exception):
        ingest_stream(stream(), paths, ck, opts).awaitTermination()
    ingest_stream(stream(), paths, ck, opts).awaitTermination()          # the second micro-batch again
    wh = Warehouse(spark, paths)
    assert wh.fact_trips.count() == 4
    q = spark.read.parquet(f"{scratch}/trips_stage/quarantine").collect()
    assert sorted(r.reason for r in q) == ["line", "line", "origin_coord", "region_length"]
    assert {r["_corrupt_record"] for r in q if r.reason == "line"} == {"V,POINT (1 1),POINT (2 2),noon,a", "V,too few"}
    with pytest.raises(ValueError):
        ingest_stream(stream(), paths, ck)


def test_hot_days_by_keyed_state(spark, scratch, tmp_path, monkeypatch):
    """Out-of-order deliveries with copies: nothing lost or doubled, written rows
    of hot days are not read again, and a run that dies after its append is made
    good."""
    import pytest
    import tripwright.streaming.ingest as I
    src = tmp_path / "hot"
    src.mkdir()
    files = [rows(5, 4) + rows(6, 3), rows(6, 5) + rows(7, 2), rows(7, 4) * 2 + rows(6, 3), rows(1, 2) + rows(7, 1),
             rows(8, 2) + rows(1, 3) + rows(5, 6)]
    for i, f in enumerate(files):
        write_csv(src / f"{i}.csv", f)
        os.utime(src / f"{i}.csv", (1_500_000_000 + i, 1_500_000_000 + i))         # a file stream goes by age
    out, ck, read = f"{scratch}/out", f"{scratch}/_ck", []
    real, follow, died = I.unseen, I.HotKeys.follow, []

    def unseen(fresh, path):
        read.append(sorted({r.datetime.day for r in fresh.collect()}))
        return real(fresh, path)

    def dies_once(self, epoch, *a):
        if epoch == 2 and not died:
            died.append(1)
            raise RuntimeError("lost driver")
        follow(self, epoch, *a)

    monkeypatch.setattr(I, "unseen", unseen)
    monkeypatch.setattr(I.HotKeys, "follow", dies_once)

    def run():
        I.write_deduplicated(trips_file_stream(spark, str(src), max_files_per_trigger=1), out, ck, hot_days=2).awaitTermination()

    with pytest.raises(Exception):
        run()
    run()
    got = sorted((r.datetime.day, r.origin_coord) for r in spark.read.parquet(out).collect())
    assert got == sorted({(int(r[3][8:10]), r[1]) for f in files for r in f})
    # The first file, the second run of the third, then days older than the last two.
    assert read == [[5, 6], [6, 7], [1], [1, 5]]
    assert len([n for n in I.child_names(spark, f"{ck}-keys") if n.startswith("epoch=")]) <= 2


def test_a_delivery_has_a_file_for_each_core(spark, scratch, monkeypatch):
    """Deliveries are written and read by all cores, a micro-batch each."""
    from tripwright.plans import registry
    from tripwright.session import child_names

    monkeypatch.setattr(registry, "default_parallelism", lambda spark: 5)
    rows = [("Vienna", f"POINT ({i} 2)", None, "2018-05-01 00:00:00", "app") for i in range(100)]
    paths, seen = TablePaths(scratch), []
    stream = registry._deliveries(spark, paths, [stage_df(spark, rows)] * 2)
    stream.writeStream.foreachBatch(lambda b, i: seen.append(b.count())).option(
        "checkpointLocation", f"{scratch}/_checkpoint").trigger(availableNow=True).start().awaitTermination()
    assert sum(n.endswith(".parquet") and n.startswith("part-") for n in child_names(spark, f"{paths.root}/files")) == 10
    assert seen == [100, 100]
