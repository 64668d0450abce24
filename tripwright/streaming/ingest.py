"""Streaming ingest of trip files.

* ``ingest_stream``: new files are picked up by the file source (its
  checkpoint is the streaming form of the ingest ledger) and every
  micro-batch runs the batch pipeline through ``foreachBatch``.  The
  pipeline's writes are insert-if-absent / overwrite, so a micro-batch
  replayed after a failure leaves the same tables: effectively exactly-once.
* ``write_deduplicated``: each distinct trip is written once, however often and
  however late it is delivered.
* ``daily_counts`` / ``write_daily_counts``: trip counts per day and region in
  event time.  Nothing is dropped for being late unless a delay is given.

``withWatermark`` needs a zoned ``timestamp``: the trip time (timestamp_ntz)
is read as UTC wall-clock time into ``event_time``.
"""

from __future__ import annotations

from dataclasses import replace
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..plans.pipeline import PipelineOptions, run_pipeline
from ..schemas import CORRUPT, TRIPS
from ..sources.csv_trips import DIALECT
from ..session import child_names, delete_path, path_exists, touch
from ..sources.tables import TablePaths, days_filter, touched_days, write_monthly

TRIP_COLUMNS = [f.name for f in TRIPS.fields]
STAGED_MONTHLY = T.StructType(TRIPS.fields + [T.StructField("year", T.IntegerType()),
                                              T.StructField("month", T.IntegerType())])


def trips_file_stream(spark: SparkSession, path: str, fmt: str = "csv",
                      max_files_per_trigger: int | None = None, strict: bool = True) -> DataFrame:
    """Stream of trip files (CSV with header, or parquet) under ``path``.

    With ``strict`` a line that is no trip ends the stream, and a restart meets
    it again.  Otherwise it comes with its text in ``_corrupt_record``, for the
    quarantine, and the stream goes on."""
    lenient = not strict and fmt == "csv"
    r = spark.readStream.schema(T.StructType([*TRIPS.fields, T.StructField(CORRUPT, T.StringType())]) if lenient else TRIPS)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    if fmt == "csv":
        return (r.options(**DIALECT).option("mode", "PERMISSIVE" if lenient else "FAILFAST")
                .option("columnNameOfCorruptRecord", CORRUPT).csv(path))
    return r.format(fmt).load(path)


def event_time(df: DataFrame, ts_col: str = "datetime") -> DataFrame:
    """``event_time``: the trip's wall-clock time read as UTC.  Built from
    the fields rather than cast, so event-time windows align to calendar
    days and hours whatever the session time zone."""
    t = F.col(ts_col)
    return df.withColumn("event_time", F.make_timestamp(
        F.year(t), F.month(t), F.dayofmonth(t), F.hour(t), F.minute(t),
        F.extract(F.lit("SECOND"), t), F.lit("UTC")))


def ingest_stream(stream: DataFrame, paths: TablePaths, checkpoint_location: str,
                  opts: PipelineOptions = PipelineOptions(), available_now: bool = True,
                  processing_time: str | None = None) -> StreamingQuery:
    """Run the batch pipeline on every micro-batch of ``stream``.

    With ``opts.strict`` off, rows that a load would reject - malformed lines of
    a lenient ``trips_file_stream``, points, times and over-long texts - go to a
    quarantine folder of their micro-batch, and the others on.  The folder has
    the micro-batch's number, so one that is run again replaces it."""
    if CORRUPT in stream.columns and opts.strict:
        raise ValueError("a lenient stream needs PipelineOptions(strict=False)")

    def each(batch: DataFrame, epoch_id: int) -> None:
        if batch.isEmpty():
            return
        columns = [*TRIP_COLUMNS, *([CORRUPT] if CORRUPT in batch.columns else [])]
        run_pipeline(batch.sparkSession, paths, batch.select(*columns),
                     replace(opts, batch_id=f"epoch-{epoch_id}"))

    w = stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint_location)
    w = w.trigger(availableNow=True) if available_now else w.trigger(
        processingTime=processing_time or "1 minute")
    return w.start()


def _key() -> Column:
    """A digest of all fields of a trip, NULLs included: what makes two one."""
    return F.unhex(F.sha2(F.to_json(F.struct(*TRIP_COLUMNS), {"ignoreNullFields": "false"}), 256))


def unseen(fresh: DataFrame, out_path: str) -> DataFrame:
    """The rows of ``fresh`` that are not among those written for the same days;
    month partitions and day ranges prune the scan."""
    spark = fresh.sparkSession
    if not path_exists(spark, out_path):
        return fresh
    days = touched_days(fresh, "datetime")
    seen = (spark.read.schema(STAGED_MONTHLY).parquet(out_path)
            .where(days_filter(days, "datetime") | F.col("datetime").isNull())
            .select(*[F.col(c).alias(f"seen_{c}") for c in TRIP_COLUMNS]))
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"seen_{c}")) for c in TRIP_COLUMNS])
    return fresh.join(seen, same, "left_anti")


class HotKeys:
    """Keyed state of a de-duplicating stream: the digests of all trips written
    for the last ``days`` calendar days, a version per micro-batch.

    A version is written after the rows it knows of.  A micro-batch that is run
    again starts from the version before it and finds its mark, which says that
    some of its rows may be written already."""

    def __init__(self, spark: SparkSession, root: str, days: int):
        self.spark, self.root, self.days = spark, root.rstrip("/"), days

    def last(self, epoch: int) -> int | None:
        """The newest complete version before a micro-batch."""
        found = [int(n.removeprefix("epoch=")) for n in child_names(self.spark, self.root) if n.startswith("epoch=")]
        done = [n for n in found if n < epoch and path_exists(self.spark, f"{self.root}/epoch={n}/_SUCCESS")]
        return max(done, default=None)

    def keys(self, version: int) -> DataFrame:
        return self.spark.read.schema("day date, key binary").parquet(f"{self.root}/epoch={version}")

    def begin(self, epoch: int) -> bool:
        """Marks a micro-batch; whether it was begun before."""
        mark = f"{self.root}/begun-{epoch}"
        if path_exists(self.spark, mark):
            return True
        touch(self.spark, mark)
        return False

    def follow(self, epoch: int, version: int | None, written: DataFrame) -> None:
        """The version after a micro-batch, from the one before and the keys that
        are written now; days that are no longer hot go."""
        known = written if version is None else self.keys(version).union(written)
        newest = known.agg(F.max("day").alias("newest"))
        hot = known.join(F.broadcast(newest), F.col("day") > F.date_sub("newest", self.days)).select("day", "key")   # one row
        hot.distinct().write.mode("overwrite").parquet(f"{self.root}/epoch={epoch}")
        for n in child_names(self.spark, self.root):        # the version before stays for a second run
            number = n.removeprefix("epoch=").removeprefix("begun-")
            if number.isdigit() and int(number) < (epoch if version is None else version):
                delete_path(self.spark, f"{self.root}/{n}")


def write_deduplicated(stream: DataFrame, out_path: str, checkpoint_location: str,
                       available_now: bool = True, hot_days: int = 0) -> StreamingQuery:
    """Append each distinct trip to ``out_path`` once, however often and
    however late it is delivered; NULL fields are equal to each other, and
    trips without a time are kept as well (in the partition without a month).

    Per micro-batch: ``dropDuplicates`` (a batch aggregate whose partial step
    collapses copies inside each task before the shuffle, so a hot group of
    copies never lands whole in one task), written aside once; then a
    null-safe anti-join against the rows already written for the same days
    (``unseen``), then a month-partitioned append.  A replayed micro-batch finds
    its rows already present.

    With ``hot_days`` the trips of so many newest calendar days are held against
    the keyed state of those days (``HotKeys``) instead, and what is written for
    them is not read again; later ones, and those of a micro-batch that is run
    again, take the exact way.
    """
    spark = stream.sparkSession
    state = HotKeys(spark, f"{checkpoint_location.rstrip('/')}-keys", hot_days) if hot_days else None

    def each(batch: DataFrame, epoch_id: int) -> None:
        if batch.isEmpty():
            return
        aside = f"{checkpoint_location.rstrip('/')}-rows/{epoch_id}"
        batch.select(*TRIP_COLUMNS).dropDuplicates(TRIP_COLUMNS).write.mode("overwrite").parquet(aside)
        fresh = spark.read.schema(TRIPS).parquet(aside)
        day = F.col("datetime").cast("date")
        version = state.last(epoch_id) if state else None
        again = state.begin(epoch_id) if state else False
        since = state.keys(version).agg(F.date_sub(F.max("day"), hot_days - 1)).first()[0] if version is not None else None
        if since is None or again:
            new = unseen(fresh, out_path)
        else:
            hot = F.coalesce(day >= F.lit(since), F.lit(False))
            new = (fresh.where(hot).withColumn("key", _key()).join(state.keys(version).select("key"), "key", "left_anti")
                   .select(*TRIP_COLUMNS))
            late = fresh.where(~hot)
            if not late.isEmpty():
                new = new.union(unseen(late, out_path))
        write_monthly(new, "datetime", out_path, mode="append")
        if state:
            rows = fresh
            if version is None:                   # the first version knows all that was written before
                rows = spark.read.schema(STAGED_MONTHLY).parquet(out_path)
            state.follow(epoch_id, version, rows.where(day.isNotNull()).select(day.alias("day"), _key().alias("key")))
        delete_path(spark, aside)

    w = stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint_location)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()


def daily_counts(stream: DataFrame, delay: str | None = None, hourly: bool = False) -> DataFrame:
    """Trips per (day, region) - or per (hour, region) with ``hourly`` - in
    event time.

    Without ``delay`` every row counts however late it is, and the state has a
    row per window and region (use output mode ``complete`` or ``update``).
    With ``delay`` rows later than that are dropped, and in append mode a window
    is emitted once the watermark passes its end.

    The window bounds are reported as ``timestamp_ntz`` taken from the trip
    time itself (one-to-one with the event-time window)."""
    t = F.col("datetime")
    if hourly:
        size, step = "1 hour", F.expr("INTERVAL 1 HOUR")
        start = F.make_timestamp_ntz(F.year(t), F.month(t), F.dayofmonth(t), F.hour(t),
                                     F.lit(0), F.lit(0))
    else:
        size, step = "1 day", F.expr("INTERVAL 1 DAY")
        start = t.cast("date").cast("timestamp_ntz")
    timed = event_time(stream)
    if delay:
        timed = timed.withWatermark("event_time", delay)
    return (timed
            .groupBy(F.window("event_time", size).alias("w"), "region", start.alias("window_start"))
            .agg(F.count(F.lit(1)).alias("number_of_trips"))
            .select("window_start", (F.col("window_start") + step).alias("window_end"),
                    "region", "number_of_trips"))


def write_daily_counts(stream: DataFrame, out_path: str, checkpoint_location: str,
                       hourly: bool = False) -> StreamingQuery:
    """Keep the table of all counts so far at ``out_path``: each micro-batch
    writes a folder of its own and then removes the older ones."""
    spark = stream.sparkSession

    def each(counts: DataFrame, epoch_id: int) -> None:
        counts.write.mode("overwrite").parquet(f"{out_path.rstrip('/')}/epoch={epoch_id}")
        for older in range(max(0, epoch_id - 2), epoch_id):
            delete_path(spark, f"{out_path.rstrip('/')}/epoch={older}")

    return (daily_counts(stream, hourly=hourly).writeStream.outputMode("complete").foreachBatch(each)
            .option("checkpointLocation", checkpoint_location).trigger(availableNow=True).start())


def read_daily_counts(spark: SparkSession, out_path: str) -> DataFrame:
    """The counts as of the last complete micro-batch."""
    rows = spark.read.schema("window_start timestamp_ntz, window_end timestamp_ntz, region string, "
                             "number_of_trips bigint, epoch bigint").parquet(out_path)
    last = rows.agg(F.max("epoch").alias("last"))
    return rows.join(F.broadcast(last), F.col("epoch") == F.col("last")).drop("epoch", "last")   # one row
