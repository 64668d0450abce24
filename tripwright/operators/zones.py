"""Primary-key check of a table whose files are sorted by time, without a shuffle
of the table.

A key that holds the time can only repeat inside a file's zone - a byte range of a
file and its span of times - or where zones overlap.  Zones come from one pass over
the time column.  Inside a zone repeats lie together and are counted in the pass
that reads them; only rows at times that two zones share are shuffled.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .quality import key_report


def zones(df: DataFrame, ts_col: str) -> DataFrame:
    """``(file, start, lo, hi, in_order)`` of every byte range of the files that
    ``df`` reads: its span of times in microseconds, and whether its rows are in
    order of time."""
    def spans(batches):
        now, lo, hi, in_order, rows = None, None, None, True, []
        for b in batches:
            file, start = b.column(0).to_numpy(zero_copy_only=False), b.column(1).to_numpy()
            ts = b.column(2).cast(pa.int64()).to_numpy(zero_copy_only=False)
            edges = [0, *(np.nonzero((file[1:] != file[:-1]) | (start[1:] != start[:-1]))[0] + 1).tolist(), len(ts)]
            for a, z in zip(edges, edges[1:]):
                if a == z:
                    continue
                part, key = ts[a:z], (file[a], int(start[a]))
                if key != now:
                    if now:
                        rows.append((*now, lo, hi, in_order))
                    now, lo, hi, in_order = key, int(part[0]), int(part[0]), True
                in_order = in_order and int(part[0]) >= hi and bool((np.diff(part) >= 0).all())
                lo, hi = min(lo, int(part.min())), max(hi, int(part.max()))
        if now:
            rows.append((*now, lo, hi, in_order))
        cols = list(zip(*rows, strict=True)) or [[]] * 5
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(
            cols, (pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.bool_()), strict=True)],
            ["file", "start", "lo", "hi", "in_order"])

    rows = df.where(F.col(ts_col).isNotNull()).select("_metadata.file_path", "_metadata.file_block_start", ts_col)
    return rows.mapInArrow(spans, "file string, start long, lo long, hi long, in_order boolean")


def shared_times(spans: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends (inclusive) of the times that more than one zone covers,
    and of zones that are not in order: 16 bytes for a zone at most."""
    month = F.date_trunc("month", F.timestamp_micros("lo"))
    before = F.max("hi").over(Window.partitionBy("month").orderBy("lo", "file", "start")
                              .rowsBetween(Window.unboundedPreceding, -1))
    # A zone that reaches into the next month is looked at in each it touches.
    each = spans.withColumn("month", F.explode(F.sequence(
        month, F.date_trunc("month", F.timestamp_micros("hi")), F.expr("INTERVAL 1 MONTH")))).withColumn("before", before)
    found = each.select(F.col("lo"), F.when(~F.col("in_order"), F.col("hi")).when(
        F.col("before") >= F.col("lo"), F.least("hi", "before")).alias("to")).where("to is not null").orderBy("lo", "to").toArrow()
    lo, to = found.column(0).to_numpy(), found.column(1).to_numpy()
    if not len(lo):
        return lo, to
    reach = np.maximum.accumulate(to)
    first = np.concatenate([[0], np.nonzero(lo[1:] > reach[:-1])[0] + 1])
    return lo[first], reach[np.concatenate([first[1:] - 1, [len(lo) - 1]])]


def zone_key_report(df: DataFrame, ts_col: str, keys: list[str], table: str) -> DataFrame:
    """``quality.key_report`` of a table read from files, its ``keys`` holding the
    time column ``ts_col``.  Rows without a time and those at shared times are
    grouped by a shuffle; all others are counted where they are read."""
    if ts_col not in keys:
        raise ValueError(f"{ts_col} must be one of the keys")
    spans = zones(df, ts_col).checkpoint(eager=True)
    lo, hi = shared_times(spans)
    ranges = df.sparkSession.sparkContext.broadcast((lo, hi))       # at most a pair per file range
    at = keys.index(ts_col)

    def is_shared(ts):
        lo, hi = ranges.value
        i = np.searchsorted(lo, ts, side="right") - 1
        return (i >= 0) & (ts <= hi[np.maximum(i, 0)]) if len(lo) else np.zeros(len(ts), bool)

    def counted(batches):
        """Rows, different keys, repeated keys and null keys of the rows that are
        not shared.  The last time's rows wait for the next batch."""
        rest, total = None, np.zeros(4, np.int64)

        def add(t: pa.Table):
            if t.num_rows:
                n = t.append_column("n", pa.array(np.ones(t.num_rows, np.int64))).group_by(keys).aggregate([("n", "sum")])
                times = n.column("n_sum").to_numpy()
                bad = sum(n.column(k).is_null().to_numpy(zero_copy_only=False) for k in keys) > 0
                total[:] += (t.num_rows, len(times), (times > 1).sum(), times[bad].sum())

        for b in batches:
            t = pa.Table.from_batches([b])
            ts = t.column(at).cast(pa.int64()).to_numpy()
            t = t.filter(pa.array(~is_shared(ts)))
            t = pa.concat_tables([rest, t]) if rest is not None else t
            if not t.num_rows:
                continue
            last = t.column(at).cast(pa.int64()).to_numpy()
            waits = last == last[-1]
            add(t.filter(pa.array(~waits)))
            rest = t.filter(pa.array(waits))
        if rest is not None:
            add(rest)
        yield pa.RecordBatch.from_arrays([pa.array([int(x)], pa.int64()) for x in total], ["n", "d", "u", "z"])

    def at_shared(batches):
        for b in batches:
            ts = b.column(at)
            known = ts.is_valid().to_numpy(zero_copy_only=False)
            found = is_shared(ts.cast(pa.int64()).fill_null(0).to_numpy(zero_copy_only=False))
            yield b.filter(pa.array(found | ~known))

    rows = df.select(*keys)
    own = rows.where(F.col(ts_col).isNotNull()).mapInArrow(counted, "n long, d long, u long, z long").agg(
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in "nduz"])
    shared = key_report(rows.mapInArrow(at_shared, rows.schema), keys, table)
    both = shared.join(own, F.lit(True))        # one row each
    out = both.select("table_name", "key_columns", *[(F.col(c) + F.col(o)).alias(c) for c, o in (
        ("row_count", "n"), ("distinct_keys", "d"), ("duplicate_keys", "u"), ("null_key_rows", "z"))])
    return out.withColumn("passed", (F.col("duplicate_keys") == 0) & (F.col("null_key_rows") == 0))
