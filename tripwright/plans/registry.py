"""Named queries over driver data: ``name -> f(spark, sf_dir) -> DataFrame``.

Warehouse-backed entries read the tables the pipeline wrote for ``sf_dir``
(built once per session).  Operator-level entries run the operator directly
on the staged driver data.  Binary ids are shown as hex text and boxes and
points as flat doubles so results compare across engines.
"""

from __future__ import annotations

import atexit
import contextlib
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..functions.geo import point_xy
from ..functions.keys import event_id, event_id_hex
from ..functions.timeparts import day_start, event_time_parts, format_day, format_timestamp
from ..operators import quality as Q
from ..operators.dims import fill_event_time, new_event_times, new_members, upsert_dim
from ..operators.facts import build_delta
from ..operators.oplog import last_event
from ..operators.zones import zone_key_report
from ..session import default_parallelism, delete_path, work_root
from ..sources.adapter import read_sf, stage_from_sf
from ..sources.csv_trips import DIALECT, read_trips, share_file_id
from ..sources.sql import register_catalog, run_query
from ..sources.tables import TablePaths, month_predicate, read_table, write_stage
from ..streaming.ingest import (ingest_stream, read_daily_counts, trips_file_stream,
                                write_daily_counts, write_deduplicated)
from . import analytics as A
from . import scenarios as S
from . import sql_text
from .pipeline import (PipelineOptions, ingest_new_files, merge_delta, run_pipeline, warehouse_for,
                       with_retries)

# Fixed query parameters.
PROBE_X, PROBE_Y = 7.5, 50.5
ENTRY_PROBE_X, ENTRY_PROBE_Y = 7.5, 45.5   # a cell present at every scale
DATASOURCE_NAME = "click"
TOP_K = 2
DECLARED_MONTH = ("2024-01-01", "2024-02-01")
STAGE_KEY = ["datetime", "region", "datasource", "origin_coord", "destination_coord"]
WINDOW = ("2024-01-08", "2024-01-15")

TRIP_COLUMNS = [f.name for f in schemas.TRIPS.fields]

Query = Callable[[SparkSession, str], DataFrame]


def flat_fact(fact: DataFrame, with_month: bool = False) -> DataFrame:
    cols = [
        "event_timestamp", event_id_hex("event_id").alias("event_id"), "region_id", "datasource_id",
        F.col("origin_coord.x").alias("origin_x"), F.col("origin_coord.y").alias("origin_y"),
        F.col("destination_coord.x").alias("destination_x"),
        F.col("destination_coord.y").alias("destination_y")]
    return fact.select(*cols, *(["year", "month"] if with_month else []))


def _empty(spark, schema):
    return spark.createDataFrame([], schema)


def _scratch(spark: SparkSession, what: str) -> TablePaths:
    """A fresh folder for a scenario's tables, removed when Python exits (the
    returned DataFrames read it until then)."""
    paths = TablePaths(work_root(spark, "scenarios", f"{what}-{uuid.uuid4().hex}"))

    def remove():
        with contextlib.suppress(Exception):     # the session may be gone already
            delete_path(spark, paths.root)

    atexit.register(remove)
    return paths


# ---- sources / staging -------------------------------------------------------

def q_stage_trips(spark, sf):
    """A stage that holds another batch is replaced, and read back."""
    paths = _scratch(spark, "stage_trips")
    write_stage(S.calendar_batch(spark, sf, "A"), paths.path("trips"), "overwrite")
    write_stage(stage_from_sf(spark, sf), paths.path("trips"), "overwrite")
    return read_table(spark, paths, "trips")


def q_csv_round_trip(spark, sf):
    """The dirty delivery's well-formed rows written as CSV in the file dialect
    and read back."""
    paths = _scratch(spark, "csv")
    good, _ = Q.split_malformed(S.dirty_stage(spark, sf))
    quoted = good.withColumn("datasource", F.concat(F.col("datasource"), F.lit(' "x", y')))
    quoted.write.options(**DIALECT, nullValue="", emptyValue='""', ignoreLeadingWhiteSpace=False,
                         ignoreTrailingWhiteSpace=False).csv(f"{paths.root}/files")
    return read_trips(spark, f"{paths.root}/files")


def q_csv_multiline(spark, sf):
    """The same rows with line breaks and quotes inside a field, read in byte ranges."""
    paths = _scratch(spark, "csv_multiline")
    good, _ = Q.split_malformed(S.dirty_stage(spark, sf))
    broken = good.withColumn("datasource", F.concat(F.col("datasource"), F.lit('\n"x",\n\ny')))
    broken.write.options(**DIALECT, nullValue="", emptyValue='""', ignoreLeadingWhiteSpace=False,
                         ignoreTrailingWhiteSpace=False).csv(f"{paths.root}/files")
    return read_trips(spark, f"{paths.root}/files", multiline=True)


def q_share_file_ids(spark, sf):
    """The file id of a share link for every event."""
    ev = read_sf(spark, sf, "events")
    links = ev.select("event_id", F.concat(F.lit("https://share.example/file/d/"), F.md5(F.concat_ws(
        "-", "event_id", "event_type")), F.lit("/view?usp=sharing")).alias("uri"))
    return links.select("event_id", share_file_id("uri").alias("file_id"))


def q_first_run_setup(spark, sf):
    """Rows per table before anything was written, when each reads as empty, and
    after the first load."""
    paths = _scratch(spark, "setup")
    names = ("trips", "dim_datasource", "dim_region", "dim_event_time", "fact_trips", "fact_group_trips")
    before = {t: read_table(spark, paths, t).count() for t in names}
    run_pipeline(spark, paths, stage_from_sf(spark, sf))
    after = Q.check_non_empty({t: read_table(spark, paths, t) for t in names})
    known = spark.createDataFrame(list(before.items()), "table_name string, rows_before long")
    return after.join(F.broadcast(known), "table_name").select("table_name", "rows_before", "row_count")   # a row per table


def q_run_log(spark, sf):
    """The log of a good load and of a strict load of the dirty delivery, which
    fails: rows by run, event and type, with the first and last place of each."""
    paths = _scratch(spark, "run_log")
    run_pipeline(spark, paths, stage_from_sf(spark, sf), PipelineOptions(log_name="good"))
    try:
        run_pipeline(spark, paths, S.dirty_stage(spark, sf), PipelineOptions(log_name="dirty"))
    except Exception:      # noqa: BLE001 - the log is what is asked for
        pass
    log = read_table(spark, paths, "trips_log")
    return log.groupBy("log_name", "event", "event_type").agg(
        F.count("*").alias("n"), F.min("log_id").alias("log_id"),
        F.min(F.col("duration_sec") >= 0).alias("timed"))


def q_retried_stage_append(spark, sf):
    """Batches appended to the stage by a step that fails after its first write:
    the second attempt leaves each row once."""
    paths = _scratch(spark, "retry")
    failed = set()

    def step(name):
        write_stage(S.calendar_batch(spark, sf, name), paths.path("trips"), "append", name)
        if name not in failed:
            failed.add(name)
            raise RuntimeError("after the write")

    for name in ("A", "B"):
        with_retries(lambda: step(name), attempts=3, wait=(0.0, 0.0))      # noqa: B023 - run at once
    return read_table(spark, paths, "trips")


def q_ledger_ingest(spark, sf):
    """Two deliveries of CSV files in one folder; each run loads what is new, in
    batches of a few files."""
    paths = _scratch(spark, "ledger")
    folder = f"{paths.root}/files"
    for name in ("A", "B"):
        S.calendar_batch(spark, sf, name).write.options(**DIALECT).mode("append").csv(folder)
        ingest_new_files(spark, paths, f"{folder}/*.csv", batch_files=4)
    if ingest_new_files(spark, paths, f"{folder}/*.csv"):
        raise AssertionError("files were loaded twice")
    return flat_fact(read_table(spark, paths, "fact_trips"))


def q_stage_append(spark, sf):
    paths = _scratch(spark, "stage_append")
    write_stage(S.calendar_batch(spark, sf, "A"), paths.path("trips"), "overwrite", "A")
    for _ in range(2):       # the second time as a retry, which changes nothing
        write_stage(S.calendar_batch(spark, sf, "B"), paths.path("trips"), "append", "B")
    return read_table(spark, paths, "trips")


def q_list_regions(spark, sf):
    return A.list_dim(warehouse_for(spark, sf).dim_region)


def q_list_datasources(spark, sf):
    return A.list_dim(warehouse_for(spark, sf).dim_datasource)


def q_trips_in_window(spark, sf):
    fact = warehouse_for(spark, sf).fact_trips
    return flat_fact(fact.where(month_predicate(*WINDOW, ts_col="event_timestamp")))


# ---- scalar functions ----------------------------------------------------------

def q_event_hash_id(spark, sf):
    s = stage_from_sf(spark, sf)
    return s.select("datetime", "region", "datasource", event_id_hex(event_id()).alias("event_id"))


def q_parse_points(spark, sf):
    s = stage_from_sf(spark, sf)
    ox, oy = point_xy("origin_coord")
    dx, dy = point_xy("destination_coord")
    return s.select("datetime", "region", ox.alias("origin_x"), oy.alias("origin_y"),
                    dx.alias("destination_x"), dy.alias("destination_y"))


def q_event_day(spark, sf):
    s = stage_from_sf(spark, sf)
    return s.select("datetime", day_start("datetime").alias("event_date"))


def q_event_time_parts(spark, sf):
    s = stage_from_sf(spark, sf)
    return s.select("datetime", *event_time_parts("datetime"))


def q_format_timestamps(spark, sf):
    s = stage_from_sf(spark, sf)
    return s.select("datetime", format_day("datetime").alias("event_date_text"),
                    format_timestamp("datetime").alias("datetime_text"),
                    format_timestamp("datetime", as_written=True).alias("datetime_text_as_written"))


# ---- dimensions ----------------------------------------------------------------

def q_distinct_regions(spark, sf):
    return stage_from_sf(spark, sf).select("region").distinct()


def q_distinct_datasources(spark, sf):
    return stage_from_sf(spark, sf).select("datasource").distinct()


def q_new_regions(spark, sf):
    prior = upsert_dim(S.first_delivery(spark, sf), _empty(spark, schemas.DIM_REGION),
                       "region", "region_id")
    return new_members(stage_from_sf(spark, sf), prior, "region")


def q_new_datasources(spark, sf):
    prior = upsert_dim(S.first_delivery(spark, sf), _empty(spark, schemas.DIM_DATASOURCE),
                       "datasource", "datasource_id")
    return new_members(stage_from_sf(spark, sf), prior, "datasource")


def q_new_event_times(spark, sf):
    prior = fill_event_time(S.first_delivery(spark, sf), _empty(spark, schemas.DIM_EVENT_TIME))
    return new_event_times(stage_from_sf(spark, sf), prior)


def q_dim_region(spark, sf):
    return upsert_dim(stage_from_sf(spark, sf), _empty(spark, schemas.DIM_REGION),
                      "region", "region_id")


def q_dim_datasource(spark, sf):
    return upsert_dim(stage_from_sf(spark, sf), _empty(spark, schemas.DIM_DATASOURCE),
                      "datasource", "datasource_id")


def q_dim_region_incremental(spark, sf):
    paths = _scratch(spark, "dim_region")
    for key in S.area_keys(spark, sf):
        batch = S.area_batch(spark, sf, key)
        dim = read_table(spark, paths, "dim_region")
        upsert_dim(batch, dim, "region", "region_id").write.mode("append").parquet(
            paths.path("dim_region"))
    return read_table(spark, paths, "dim_region")


def q_dim_event_time(spark, sf):
    return fill_event_time(stage_from_sf(spark, sf), _empty(spark, schemas.DIM_EVENT_TIME))


# ---- facts ---------------------------------------------------------------------

def q_fact_delta_trips(spark, sf):
    wh = warehouse_for(spark, sf)
    return flat_fact(build_delta(stage_from_sf(spark, sf), wh.dim_region, wh.dim_datasource))


def q_fact_trips(spark, sf):
    fact = warehouse_for(spark, sf).fact_trips
    return flat_fact(fact, with_month=True)


def q_fact_trips_incremental(spark, sf):
    """Load A, then B, then A again through delta + insert-if-absent."""
    paths = _scratch(spark, "fact_trips")
    wh = warehouse_for(spark, sf)
    dim_region, dim_datasource = wh.dim_region, wh.dim_datasource
    for name in ("A", "B", "A"):
        delta = build_delta(S.calendar_batch(spark, sf, name), dim_region, dim_datasource)
        merge_delta(spark, paths, delta)
    return flat_fact(read_table(spark, paths, "fact_trips"))


def q_fact_group_trips(spark, sf):
    return A.flat_group(warehouse_for(spark, sf).fact_group_trips)


def q_fact_group_envelope(spark, sf):
    return A.flat_group(warehouse_for(spark, sf).fact_group_envelope)


# ---- named questions -----------------------------------------------------------

def q_check_position(spark, sf):
    wh = warehouse_for(spark, sf)
    return A.check_position(wh.fact_group_trips, wh.dim_region, PROBE_X, PROBE_Y)


def q_check_position_envelope(spark, sf):
    wh = warehouse_for(spark, sf)
    return A.check_position(wh.fact_group_envelope, wh.dim_region, PROBE_X, PROBE_Y)


def flagship(spark, sf):
    """Position lookup over the true (envelope) daily boxes of every region."""
    wh = warehouse_for(spark, sf)
    return A.check_position(wh.fact_group_envelope, wh.dim_region,
                            ENTRY_PROBE_X, ENTRY_PROBE_Y)


def q_points_in_boxes(spark, sf):
    wh = warehouse_for(spark, sf)
    return A.trip_origins_in_boxes(wh.fact_trips, wh.fact_group_envelope)


def q_regions_of_datasource(spark, sf):
    wh = warehouse_for(spark, sf)
    return A.regions_of_datasource(wh.fact_trips, wh.dim_region, wh.dim_datasource,
                                   DATASOURCE_NAME)


def q_region_trip_counts(spark, sf):
    return A.region_trip_stats(warehouse_for(spark, sf).fact_trips).select(
        "region_id", "number_of_trips")


def q_region_latest_trip(spark, sf):
    return A.region_trip_stats(warehouse_for(spark, sf).fact_trips).select(
        "region_id", "event_timestamp")


def q_region_rank(spark, sf):
    return A.region_rank(warehouse_for(spark, sf).fact_trips)


def q_latest_datasource_top2(spark, sf):
    wh = warehouse_for(spark, sf)
    return A.latest_datasource_top(wh.fact_trips, wh.dim_region, wh.dim_datasource, TOP_K)


def q_weekly_trips(spark, sf):
    wh = warehouse_for(spark, sf)
    return A.weekly_trips(wh.fact_group_trips, wh.dim_region, wh.dim_day)


def q_weekly_avg_trips(spark, sf):
    wh = warehouse_for(spark, sf)
    return A.weekly_avg_trips(wh.fact_group_trips, wh.dim_region, wh.dim_day)


def q_weekly_avg_trips_by_year(spark, sf):
    wh = warehouse_for(spark, sf)
    return A.weekly_avg_trips(wh.fact_group_trips, wh.dim_region, wh.dim_day, by_year=True)


def q_last_event(spark, sf):
    """Latest row of an event log, here the driver's ``events`` table read as
    one (log_id = event_id, event = event_type)."""
    ev = read_sf(spark, sf, "events")
    return last_event(ev, id_col="event_id", event_col="event_type", type_col=None,
                      ts_col="ts")


def q_last_log_event(spark, sf):
    """The last row of a run log, in both time formats.  The log is written in
    the log table's schema, a row per driver event."""
    paths = _scratch(spark, "log")
    ev = read_sf(spark, sf, "events")
    kind = F.element_at(F.array(F.lit("start"), F.lit("end"), F.lit("failed")),
                        (F.col("event_id") % 3 + 1).cast("int"))
    ev.select((F.col("event_id") + 1).cast("int").alias("log_id"), F.lit("trips").alias("log_name"),
              F.lit("v1").alias("pipeline_version_instance"), F.col("event_type").alias("event"),
              kind.alias("event_type"), F.col("ts").cast("timestamp_ntz").alias("execution_date_time"),
              F.lit(0.0).alias("duration_sec")).write.mode("append").parquet(paths.path("trips_log"))
    return last_event(read_table(spark, paths, "trips_log"), both=True)


# ---- bound SQL -----------------------------------------------------------------

def q_sql_regions_of_datasource(spark, sf):
    register_catalog(spark, warehouse_for(spark, sf).paths)
    return run_query(spark, sql_text.REGIONS_OF_DATASOURCE, {"datasource": DATASOURCE_NAME})


def q_sql_latest_datasource_top2(spark, sf):
    register_catalog(spark, warehouse_for(spark, sf).paths)
    return run_query(spark, sql_text.LATEST_DATASOURCE_TOP, {"k": TOP_K})


def q_sql_weekly_avg_trips(spark, sf):
    register_catalog(spark, warehouse_for(spark, sf).paths)
    return run_query(spark, sql_text.WEEKLY_AVG_TRIPS)


def q_sql_check_position(spark, sf):
    register_catalog(spark, warehouse_for(spark, sf).paths)
    return run_query(spark, sql_text.CHECK_POSITION, {"x": PROBE_X, "y": PROBE_Y})


def q_sql_table_rows(spark, sf):
    """A table named by a parameter."""
    register_catalog(spark, warehouse_for(spark, sf).paths)
    return run_query(spark, "SELECT count(*) AS n FROM IDENTIFIER(:name)", {"name": "trips.fact_trips"})


# ---- streaming -----------------------------------------------------------------

FILES_PER_DELIVERY = 2     # at least; else one for each core, all are written and read at once


def _finished(query) -> None:
    query.awaitTermination()
    if query.exception():
        raise query.exception()


def _deliveries(spark, paths, batches):
    """A stream with a micro-batch for each of the batches."""
    files = max(FILES_PER_DELIVERY, default_parallelism(spark))
    folder = S.delivery_files(spark, batches, f"{paths.root}/files", files)
    return trips_file_stream(spark, folder, "parquet", files)


def q_stream_ingest_fact(spark, sf):
    """Overlapping deliveries A, B and A again through the per-micro-batch pipeline."""
    paths = _scratch(spark, "stream_ingest")
    stream = _deliveries(spark, paths, [S.calendar_batch(spark, sf, n) for n in ("A", "B", "A")])
    _finished(ingest_stream(stream, paths, f"{paths.root}/_checkpoint"))
    return flat_fact(read_table(spark, paths, "fact_trips"))


def q_stream_dedupe(spark, sf):
    """The dirty delivery (with NULLs in every field, rows twice) delivered two
    times, each distinct row written once."""
    paths = _scratch(spark, "stream_dedupe")
    out = paths.path("trips")
    stream = _deliveries(spark, paths, [S.dirty_stage(spark, sf)] * 2)
    _finished(write_deduplicated(stream, out, f"{paths.root}/_checkpoint"))
    return spark.read.parquet(out).select(*TRIP_COLUMNS)


def q_stream_dedupe_hot(spark, sf):
    """Overlapping deliveries out of order, A, B, A and the dirty one twice: each
    distinct row written once, those of the last days by the keyed state."""
    paths = _scratch(spark, "stream_dedupe_hot")
    out, dirty = paths.path("trips"), S.dirty_stage(spark, sf)
    batches = [S.calendar_batch(spark, sf, n) for n in ("A", "B", "A")] + [dirty, dirty]
    _finished(write_deduplicated(_deliveries(spark, paths, batches), out, f"{paths.root}/_checkpoint", hot_days=10))
    return spark.read.parquet(out).select(*TRIP_COLUMNS)


def q_stream_daily_counts(spark, sf):
    """Trips per (day, region); the later half of the month arrives first."""
    paths = _scratch(spark, "stream_daily")
    day = F.dayofmonth("ts")
    stream = _deliveries(spark, paths, [
        stage_from_sf(spark, sf, events_filter=day > 15), stage_from_sf(spark, sf, events_filter=day <= 15)])
    out = f"{paths.root}/counts"
    _finished(write_daily_counts(stream, out, f"{paths.root}/_checkpoint"))
    return read_daily_counts(spark, out)


# ---- quality -------------------------------------------------------------------

def q_dq_row_counts(spark, sf):
    wh = warehouse_for(spark, sf)
    tables = {t: wh.table(t) for t in ("trips", "dim_datasource", "dim_region", "dim_event_time",
                                        "fact_trips", "fact_group_trips")}
    return Q.check_non_empty(tables)


def q_dq_primary_keys(spark, sf):
    wh = warehouse_for(spark, sf)
    reps = [Q.key_report(wh.table(t), schemas.PRIMARY_KEYS[t], t)
            for t in ("dim_datasource", "dim_region", "fact_group_trips")]
    # Sorted by time inside their files: no shuffle of the table.
    reps += [zone_key_report(spark.read.schema(wh.paths.schema(t)).parquet(wh.paths.path(t)),
                             "event_timestamp", schemas.PRIMARY_KEYS[t], t) for t in ("dim_event_time", "fact_trips")]
    reps.append(Q.key_report(S.dirty_stage(spark, sf), STAGE_KEY, "trips"))
    out = reps[0]
    for r in reps[1:]:
        out = out.unionByName(r)
    return out


def q_dq_duplicate_keys(spark, sf):
    """Fact keys occurring more than once when overlapping deliveries are
    appended to the stage and the delta keeps duplicates."""
    wh = warehouse_for(spark, sf)
    stage = q_stage_append(spark, sf)
    delta = build_delta(stage, wh.dim_region, wh.dim_datasource, on_duplicate="keep")
    dup = Q.duplicate_keys(delta, schemas.PRIMARY_KEYS["fact_trips"])
    return dup.select("event_timestamp", event_id_hex("event_id").alias("event_id"),
                      F.col("n").alias("copies"))


def q_dq_null_keys(spark, sf):
    return q_dq_primary_keys(spark, sf).select("table_name", "key_columns", "null_key_rows")


def q_dq_partition_bounds(spark, sf):
    return Q.bounds_report(S.dirty_warehouse(spark, sf).fact_trips, "event_timestamp", *DECLARED_MONTH)


def q_dq_varchar_length(spark, sf):
    return Q.length_report(S.dirty_stage(spark, sf))


def q_dq_malformed_points(spark, sf):
    return Q.malformed_report(S.dirty_stage(spark, sf))


def q_dirty_quarantine(spark, sf):
    """Rows that the lenient load of the dirty delivery set aside, by reason."""
    wh = S.dirty_warehouse(spark, sf)
    return (spark.read.parquet(f"{wh.paths.root}/trips_stage/quarantine")
            .groupBy("reason").agg(F.count("*").alias("n")))


def q_dirty_fact_trips(spark, sf):
    """The fact of that load: copies once, rows without region or datasource out."""
    return flat_fact(S.dirty_warehouse(spark, sf).fact_trips)


def q_dirty_fact_group_trips(spark, sf):
    return A.flat_group(S.dirty_warehouse(spark, sf).fact_group_trips)


QUERIES: dict[str, Query] = {
    "stage_trips": q_stage_trips,
    "stage_append": q_stage_append,
    "csv_round_trip": q_csv_round_trip,
    "csv_multiline": q_csv_multiline,
    "share_file_ids": q_share_file_ids,
    "first_run_setup": q_first_run_setup,
    "run_log": q_run_log,
    "retried_stage_append": q_retried_stage_append,
    "ledger_ingest": q_ledger_ingest,
    "list_regions": q_list_regions,
    "list_datasources": q_list_datasources,
    "trips_in_window": q_trips_in_window,
    "event_hash_id": q_event_hash_id,
    "parse_points": q_parse_points,
    "event_day": q_event_day,
    "event_time_parts": q_event_time_parts,
    "format_timestamps": q_format_timestamps,
    "distinct_regions": q_distinct_regions,
    "distinct_datasources": q_distinct_datasources,
    "new_regions": q_new_regions,
    "new_datasources": q_new_datasources,
    "new_event_times": q_new_event_times,
    "dim_region": q_dim_region,
    "dim_datasource": q_dim_datasource,
    "dim_region_incremental": q_dim_region_incremental,
    "dim_event_time": q_dim_event_time,
    "fact_delta_trips": q_fact_delta_trips,
    "fact_trips": q_fact_trips,
    "fact_trips_incremental": q_fact_trips_incremental,
    "fact_group_trips": q_fact_group_trips,
    "fact_group_envelope": q_fact_group_envelope,
    "check_position": q_check_position,
    "check_position_envelope": q_check_position_envelope,
    "points_in_boxes": q_points_in_boxes,
    "regions_of_datasource": q_regions_of_datasource,
    "region_trip_counts": q_region_trip_counts,
    "region_latest_trip": q_region_latest_trip,
    "region_rank": q_region_rank,
    "latest_datasource_top2": q_latest_datasource_top2,
    "weekly_trips": q_weekly_trips,
    "weekly_avg_trips": q_weekly_avg_trips,
    "weekly_avg_trips_by_year": q_weekly_avg_trips_by_year,
    "last_event": q_last_event,
    "last_log_event": q_last_log_event,
    "sql_regions_of_datasource": q_sql_regions_of_datasource,
    "sql_latest_datasource_top2": q_sql_latest_datasource_top2,
    "sql_weekly_avg_trips": q_sql_weekly_avg_trips,
    "sql_check_position": q_sql_check_position,
    "sql_table_rows": q_sql_table_rows,
    "stream_ingest_fact": q_stream_ingest_fact,
    "stream_dedupe": q_stream_dedupe,
    "stream_dedupe_hot": q_stream_dedupe_hot,
    "stream_daily_counts": q_stream_daily_counts,
    "dq_row_counts": q_dq_row_counts,
    "dq_primary_keys": q_dq_primary_keys,
    "dq_duplicate_keys": q_dq_duplicate_keys,
    "dq_null_keys": q_dq_null_keys,
    "dq_partition_bounds": q_dq_partition_bounds,
    "dq_varchar_length": q_dq_varchar_length,
    "dq_malformed_points": q_dq_malformed_points,
    "dirty_quarantine": q_dirty_quarantine,
    "dirty_fact_trips": q_dirty_fact_trips,
    "dirty_fact_group_trips": q_dirty_fact_group_trips,
}
