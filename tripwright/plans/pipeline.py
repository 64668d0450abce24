"""The load pipeline: stage -> dimensions -> delta -> fact -> group fact -> checks.

Each step reads the tables the previous step wrote, so lineage is cut at
every step (a lost executor only re-runs tasks of the current step), and
every write is re-runnable: dimensions and the fact are insert-if-absent, the
stage and the quarantine overwrite the folder of their batch, the group tables
are overwritten by month.

The group tables follow from ``fact_group_state``, mergeable extremes and counts
per (day, region).  A batch is merged into it through the rows it inserted, never
by reading the fact again.  That must happen exactly once, so the inserted rows
are written to a folder of the open batch before the fact changes, and the merged
months beside them before the state does; a run that dies leaves the folder, and
the next one, whatever it loads, takes up where that one stopped.  A single writer
per warehouse is assumed.
"""

from __future__ import annotations

import datetime as dt
import random
import threading
import time
import uuid
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, replace
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions.timeparts import day_start
from ..operators.dims import fill_days, fill_event_time, upsert_dim
from ..operators.facts import (build_delta, group_boxes, group_extremes, insert_if_absent,
                               merge_extremes)
from ..operators.oplog import LogWriter, logged
from ..operators.quality import (check_non_empty, enforce_lengths, group_total_report,
                                 key_report, require, split_malformed)
from ..operators.sketch import may_match
from ..schemas import PRIMARY_KEYS
from ..session import delete_path, folder_size, path_exists, rename_path, touch, work_root
from ..sources.adapter import stage_from_sf
from ..sources.compaction import compact_months, finish_compaction
from ..sources.csv_trips import read_trips
from ..sources.ledger import BATCH_BYTES, BATCH_FILES, open_plan, plan_batches, record_files
from ..sources.tables import (TablePaths, days_filter, months_filter, months_of, read_table,
                              stage_batch, touched_days, with_month_columns, write_by_place,
                              write_monthly, write_stage)


@dataclass(frozen=True)
class PipelineOptions:
    stage_mode: str = "overwrite"        # 'overwrite' (replace) or 'append'
    on_duplicate: str = "drop"           # 'drop', 'fail' or 'keep'
    strict: bool = True                  # malformed points raise; else quarantine
    # 'delta': merge the inserted rows; 'touched': recompute the batch's days
    # from the fact; 'full': rebuild from the whole fact.
    group_refresh: str = "delta"
    batch_id: str | None = None          # names the batch; loading it again replaces it
    check_quality: bool = True
    # Also check fact/group keys on the touched days.  Insert-if-absent
    # already guarantees them; this guards against writes from outside.
    check_keys: bool = False
    pipeline_version_instance: str = "v1"
    log_name: str = "trips"
    # Bytes of the touched months from which a batch's keys are sketched to prune
    # the fact's side of the anti-join (two more passes over the batch); None: never.
    sketch_bytes: int | None = 8 << 30
    compact: bool = True                 # rewrite months that got too many small files
    step_attempts: int = 1               # whole-step retries (steps are re-runnable)
    retry_wait: tuple[float, float] = (1.0, 2.0)   # random wait between attempts, seconds


def with_retries(fn, attempts: int, wait: tuple[float, float]):
    """Run ``fn`` up to ``attempts`` times.  Spark already retries failed
    tasks; this covers a whole step failing on the driver side.  Safe because
    every step's writes are insert-if-absent or overwrite what the same batch
    wrote before."""
    for attempt in range(1, max(1, attempts) + 1):
        try:
            return fn()
        except Exception:
            if attempt >= attempts:
                raise
            time.sleep(random.uniform(*wait))


def load_stage(spark: SparkSession, paths: TablePaths, source: DataFrame,
               opts: PipelineOptions) -> list[dt.date]:
    """Write the batch to the staging table; return the calendar days it covers.

    The set of days is observed while the stage is written (no extra pass); it
    is bounded by the batch's calendar span.  With ``append`` the stage also
    holds earlier batches, which the later steps don't read.
    """
    root, batch = paths.root.rstrip("/"), opts.batch_id or uuid.uuid4().hex
    landing = None
    if not opts.strict:
        # Lenient: malformed rows go to a quarantine folder, the rest on.  The
        # source is read once; the copy goes when both are written.
        landing = f"{root}/_staging/incoming/{uuid.uuid4().hex}"
        source.write.parquet(landing)
        source, bad = split_malformed(spark.read.schema(source.schema).parquet(landing))
        write_stage(bad, f"{root}/trips_stage/quarantine", "append", batch)
    else:
        source = enforce_lengths(source)
    obs = Observation("stage_days")
    observed = source.observe(
        obs, F.array_sort(F.collect_set(F.col("datetime").cast("date"))).alias("days"))
    write_stage(observed, paths.path("trips"), opts.stage_mode, batch)
    if landing:
        delete_path(spark, landing)
    return list(obs.get.get("days") or [])


def update_dimensions(spark: SparkSession, paths: TablePaths, opts: PipelineOptions,
                      days: list[dt.date]) -> None:
    """The dimensions are independent: their jobs are submitted from a
    small thread pool and share the cluster (Spark schedules concurrent jobs)."""
    stage = stage_batch(spark, paths, opts.batch_id)

    def surrogate(table, key, id_col):
        dim = read_table(spark, paths, table)
        upsert_dim(stage, dim, key, id_col).write.mode("append").parquet(paths.path(table))

    def event_time():
        # Only the touched days of the time dimension can hold a batch timestamp.
        dim_time = read_table(spark, paths, "dim_event_time").where(
            days_filter(days, "event_timestamp"))
        write_monthly(fill_event_time(stage, dim_time), "event_timestamp",
                      paths.path("dim_event_time"), mode="append")

    def day_starts():
        if not path_exists(spark, paths.path("dim_day")):      # a warehouse from before it was kept
            times = read_table(spark, paths, "dim_event_time").where(F.col("hour") == 0)
            times.where(F.col("event_timestamp") == day_start("event_timestamp")).coalesce(1).write.parquet(
                paths.path("dim_day"))
        fill_days(spark, days, read_table(spark, paths, "dim_day")).coalesce(1).write.mode("append").parquet(
            paths.path("dim_day"))

    with ThreadPoolExecutor(max_workers=4, thread_name_prefix="tripwright-dims") as pool:
        futures = [pool.submit(surrogate, "dim_datasource", "datasource", "datasource_id"),
                   pool.submit(surrogate, "dim_region", "region", "region_id"),
                   pool.submit(event_time), pool.submit(day_starts)]
        for f in futures:
            f.result()


def update_facts(spark: SparkSession, paths: TablePaths, opts: PipelineOptions,
                 days: list[dt.date]) -> None:
    finish_open_batch(spark, paths, opts)         # what an earlier run left undone
    stage = stage_batch(spark, paths, opts.batch_id)
    delta = build_delta(stage, read_table(spark, paths, "dim_region"),
                        read_table(spark, paths, "dim_datasource"), opts.on_duplicate, opts.strict)
    merge_delta(spark, paths, delta, opts.on_duplicate == "keep", days, opts)


def open_batch(paths: TablePaths) -> str:
    return f"{paths.root.rstrip('/')}/_staging/open_batch"


def merge_delta(spark: SparkSession, paths: TablePaths, delta: DataFrame, dedupe: bool = False,
                days: list[dt.date] | None = None, opts: PipelineOptions = PipelineOptions()) -> list[dt.date]:
    """Write the delta table, insert its rows absent from the fact, and bring
    the group tables up to date.

    The fact side of the anti-join is narrowed to the days the delta covers;
    when they are not given they are observed while the delta is written.
    Returns those days."""
    if days is None:
        obs = Observation("delta_days")
        delta = delta.observe(obs, F.array_sort(F.collect_set(
            F.col("event_timestamp").cast("date"))).alias("days"))
        delta.write.mode("overwrite").parquet(paths.path("fact_delta_trips"))
        days = list(obs.get.get("days") or [])
    else:
        delta.write.mode("overwrite").parquet(paths.path("fact_delta_trips"))
    written = read_table(spark, paths, "fact_delta_trips")
    existing = read_table(spark, paths, "fact_trips").where(days_filter(days, "event_timestamp"))
    if opts.sketch_bytes is not None and opts.sketch_bytes <= sum(folder_size(
            spark, f"{paths.path('fact_trips')}/year={y}/month={m}")[1] for y, m in months_of(days)):
        existing = may_match(existing, PRIMARY_KEYS["fact_trips"], written, written.count())
    folder = open_batch(paths)
    insert_if_absent(written, existing, dedupe=dedupe).write.mode("overwrite").parquet(f"{folder}/inserted")
    finish_open_batch(spark, paths, opts, days)
    return days


def finish_open_batch(spark: SparkSession, paths: TablePaths, opts: PipelineOptions,
                      days: list[dt.date] | None = None) -> None:
    """Append the open batch's inserted rows to the fact, merge them into the
    group tables, and close it.  Each part is done once, however often it is
    begun: an append that may have died half way is made good by an anti-join
    with the fact, and the merged months are only computed while the state is
    still the old one."""
    folder = open_batch(paths)
    if not path_exists(spark, f"{folder}/inserted/_SUCCESS"):
        delete_path(spark, folder)                # it died before the fact changed
        return
    inserted = spark.read.schema(paths.schema("fact_delta_trips")).parquet(f"{folder}/inserted")
    if days is None:
        days = touched_days(inserted, "event_timestamp")
    if not path_exists(spark, f"{folder}/appended"):
        rows = inserted
        if path_exists(spark, f"{folder}/appending"):
            there = read_table(spark, paths, "fact_trips").where(days_filter(days, "event_timestamp"))
            rows = insert_if_absent(inserted, there, dedupe=False)
        touch(spark, f"{folder}/appending")
        write_monthly(rows, "event_timestamp", paths.path("fact_trips"), mode="append")
        touch(spark, f"{folder}/appended")
    if opts.group_refresh != "delta" or not inserted.isEmpty():
        refresh_groups(spark, paths, opts, days, inserted)
    # Closed by one rename: a folder that is half deleted would look open.
    closed = f"{folder}-closed-{uuid.uuid4().hex}"
    rename_path(spark, folder, closed)
    delete_path(spark, closed)


GROUP_TABLES = {"fact_group_trips": "as_written", "fact_group_envelope": "envelope"}


def refresh_groups(spark: SparkSession, paths: TablePaths, opts: PipelineOptions,
                   days: list[dt.date], inserted: DataFrame) -> None:
    """Bring ``fact_group_state`` and both group tables up to date.

    ``delta``: the months of the state that the batch touches are merged with
    the extremes of its inserted rows.  ``touched``: the given days are computed
    anew from the fact (partition- and row-group-pruned), the other days of
    their months stay.  ``full``, or a warehouse without a state: all from the
    fact.  The new months are written beside the open batch first, complete or
    not at all, and all three tables are then overwritten from there - so none
    is overwritten by a job that reads it, and a second attempt changes nothing.
    """
    mode = opts.group_refresh
    if mode not in ("delta", "touched", "full"):
        raise ValueError(f"group_refresh must be delta, touched or full, not {mode!r}")
    known = path_exists(spark, paths.path("fact_group_state"))
    if mode != "full" and known and not days:
        return
    aside = f"{open_batch(paths)}/state"
    if not path_exists(spark, f"{aside}/_SUCCESS"):
        state = read_table(spark, paths, "fact_group_state").where(months_filter(months_of(days)))
        if mode == "delta" and known:
            fresh = merge_extremes(state, group_extremes(inserted))
        elif mode == "touched" and known:
            fact = read_table(spark, paths, "fact_trips").where(days_filter(days, "event_timestamp"))
            kept = state.where(~days_filter(days, "event_date")).drop("year", "month")
            fresh = group_extremes(fact).unionByName(kept)
        else:
            fresh = group_extremes(read_table(spark, paths, "fact_trips"))
        with_month_columns(fresh, "event_date").write.mode("overwrite").parquet(aside)
    fresh = spark.read.schema(paths.schema("fact_group_state")).parquet(aside)
    dynamic = mode != "full" and known

    def overwrite(table):
        if table in GROUP_TABLES:
            write_by_place(group_boxes(fresh, GROUP_TABLES[table]), "event_date", paths.path(table), dynamic=dynamic)
        else:
            write_monthly(fresh, "event_date", paths.path(table), mode="overwrite", dynamic=dynamic)

    with ThreadPoolExecutor(max_workers=len(GROUP_TABLES), thread_name_prefix="tripwright-groups") as pool:
        list(pool.map(overwrite, GROUP_TABLES))
    overwrite("fact_group_state")         # last: it says that a state is there


def check_batch(spark: SparkSession, paths: TablePaths, days: list[dt.date],
                keys: bool = True) -> None:
    """Every table non-empty, and every trip of the days this batch touched
    counted in both group tables (only they can have changed); with ``keys``
    also the fact and group keys unique and not NULL on those days."""
    require(check_non_empty(quality_tables(spark, paths), counted=False))
    fact = read_table(spark, paths, "fact_trips").where(days_filter(days, "event_timestamp"))
    groups = {t: read_table(spark, paths, t).where(days_filter(days, "event_date")) for t in GROUP_TABLES}
    require(group_total_report(fact, groups))
    if keys:
        require(key_report(fact, PRIMARY_KEYS["fact_trips"], "fact_trips").unionByName(key_report(
            groups["fact_group_trips"], PRIMARY_KEYS["fact_group_trips"], "fact_group_trips")))


def quality_tables(spark: SparkSession, paths: TablePaths) -> dict[str, DataFrame]:
    return {t: read_table(spark, paths, t)
            for t in ("dim_datasource", "dim_region", "dim_event_time", "fact_trips",
                      "fact_group_trips")}


# Appended tables and their time columns.
APPENDED = {"fact_trips": "event_timestamp", "dim_event_time": "event_timestamp"}


def compact_tables(spark: SparkSession, paths: TablePaths, days: list[dt.date]) -> None:
    """Rewrite the batch's months of the appended tables where they got too many
    small files."""
    for table, ts_col in APPENDED.items():
        compact_months(spark, paths, table, months_of(days), ts_col)


def run_pipeline(spark: SparkSession, paths: TablePaths, source: DataFrame,
                 opts: PipelineOptions = PipelineOptions()) -> TablePaths:
    """Run every step in dependency order, each logged to ``trips_log``."""
    opts = opts if opts.batch_id else replace(opts, batch_id=uuid.uuid4().hex)   # one id for all attempts
    log = LogWriter(spark, paths.path("trips_log"))
    v = opts.pipeline_version_instance
    try:
        def step(event, fn):
            # One start and one end/failed row per step, however many attempts.
            with logged(spark, log, opts.log_name, event, v):
                return with_retries(fn, opts.step_attempts, opts.retry_wait)

        for table, ts_col in APPENDED.items():      # what an earlier run may have left half swapped
            finish_compaction(spark, paths, table, ts_col)
        days = step("load_stage", lambda: load_stage(spark, paths, source, opts))
        step("update_dimension_tables", lambda: update_dimensions(spark, paths, opts, days))
        step("update_fact_tables", lambda: update_facts(spark, paths, opts, days))
        if opts.compact:
            compact_tables(spark, paths, days)
        if opts.check_quality:
            step("data_quality", lambda: check_batch(spark, paths, days, opts.check_keys))
    finally:
        log.close()
    return paths


def ingest_new_files(spark: SparkSession, paths: TablePaths, pattern: str,
                     opts: PipelineOptions = PipelineOptions(), batch_bytes: int = BATCH_BYTES,
                     batch_files: int = BATCH_FILES) -> int:
    """Load the trip files under ``pattern`` that were not loaded before, batch
    by batch; returns how many files were.

    A batch has at most ``batch_files`` files and, but for the last of them,
    ``batch_bytes``; its names, and no others, are handed to the reader.  It is
    recorded in the ledger after its load: a run that dies in between goes on
    with it, under the same batch id, and loading rows again changes nothing.
    """
    logs = f"{paths.root.rstrip('/')}/logs"
    ledger, loaded = f"{logs}/ingested_files", 0
    plan = open_plan(spark, f"{logs}/ingest_plans", pattern, ledger, batch_bytes, batch_files)
    while plan:
        folder, plan_id = plan
        for batch_id, files in plan_batches(spark, folder, plan_id, ledger):
            names = [unquote(r.path) for r in files.select("path").limit(batch_files).toLocalIterator()]
            run_pipeline(spark, paths, read_trips(spark, names, opts.strict), replace(opts, batch_id=batch_id))
            record_files(files, ledger, batch_id)
            loaded += len(names)
        delete_path(spark, folder)
        # A plan that an earlier run had begun may not hold the newest files.
        plan = open_plan(spark, f"{logs}/ingest_plans", pattern, ledger, batch_bytes, batch_files)
    return loaded


class Warehouse:
    """Typed readers over a written warehouse."""

    def __init__(self, spark: SparkSession, paths: TablePaths):
        self.spark = spark
        self.paths = paths

    def table(self, name: str) -> DataFrame:
        return read_table(self.spark, self.paths, name)

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self.table(name)


_BUILT: dict[tuple, TablePaths] = {}
_LOCK = threading.Lock()


def warehouse_for(spark: SparkSession, sf_dir: str,
                  opts: PipelineOptions = PipelineOptions(), source=stage_from_sf) -> Warehouse:
    """Warehouse loaded from a driver data folder, built once per session;
    ``source(spark, sf_dir)`` gives the trips.

    The tables are written under the session's checkpoint folder; later calls
    in the same application reuse them.
    """
    key = (spark.sparkContext.applicationId, sf_dir, opts, source.__name__)
    with _LOCK:
        paths = _BUILT.get(key)
        if paths is None:
            paths = TablePaths(work_root(spark, "warehouse", uuid.uuid4().hex))
            run_pipeline(spark, paths, source(spark, sf_dir), opts)
            _BUILT[key] = paths
    return Warehouse(spark, paths)
