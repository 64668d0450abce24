"""CSV files with line breaks inside quoted fields, read by many tasks.

Whether a line begins a record depends on all quotes before it, so Spark's own
multi-line reader gives a whole file to one task.  Here files are read as lines, in
byte ranges like any text file.  One pass finds, for each range and for both states
it may begin in (between records, or inside quotes), the state it ends in; put one
after the other, these tell the state every range really begins in.  A second pass
joins lines to records, within a range.  Only the pieces of records that cross from
one range to the next - two a range at most - are shuffled, to be put together.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

QUOTE, DELIMITER = '"', ","
# A closed quoted field, its inside with doubled quotes, and what is left of a field.
CLOSED = re.compile(r'"(?:[^"]|"")*+"(?!")')
REST = re.compile(r'(?:[^"]|"")*+"(?!")')
FIELD = re.compile(r"[^,]*+,?")

WHOLE, HEAD, TAIL, MIDDLE = range(4)


def open_after(line: str, inside: bool) -> bool:
    """Whether a quoted field is open at the end of ``line``, given whether one
    is at its start.  A quote that doesn't begin a field is an ordinary character."""
    at = 0
    if inside:
        m = REST.match(line)
        if not m:
            return True
        at = FIELD.match(line, m.end()).end()
        if line[at - 1:at] != DELIMITER:          # the line's last field
            return False
    elif QUOTE not in line:
        return False
    while True:
        if line[at:at + 1] == QUOTE:
            m = CLOSED.match(line, at)
            if not m:
                return True
            at = m.end()
        at = FIELD.match(line, at).end()
        if at >= len(line):
            return False


def _range_key(file: str, start: int) -> int:
    return xxh64_intdigest(f"{start} {file}".encode())


def _lines(spark: SparkSession, paths: list[str]) -> DataFrame:
    return spark.read.option("lineSep", "\n").text(paths).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), "value")


def _ranges_open_at_start(lines: DataFrame) -> list[int]:
    """Keys of the byte ranges that begin inside quotes: eight bytes for such a
    range of a file, however many lines it has."""
    def ends(batches):
        now, state = None, [False, True]
        rows = []
        for b in batches:
            for file, start, line in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if (file, start) != now:
                    if now:
                        rows.append((*now, *state))
                    now, state = (file, start), [False, True]
                state = [open_after(line, s) for s in state] if QUOTE in line else state
        if now:
            rows.append((*now, *state))
        cols = list(zip(*rows, strict=True)) or [[]] * 4
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(
            cols, (pa.string(), pa.int64(), pa.bool_(), pa.bool_()), strict=True)], ["file", "start", "closed", "open"])

    def follow(table: pa.Table) -> pa.Table:
        inside, found = False, []
        for r in table.sort_by("start").to_pylist():
            if inside:
                found.append(_range_key(r["file"], r["start"]) - (1 << 63))
            inside = r["open"] if inside else r["closed"]
        return pa.table({"key": pa.array(found, pa.int64())})

    each = lines.mapInArrow(ends, "file string, start long, closed boolean, open boolean")     # a row per range
    return [r["key"] + (1 << 63) for r in each.groupBy("file").applyInArrow(follow, "key long").toLocalIterator()]


def read_records(spark: SparkSession, paths: list[str]) -> DataFrame:
    """``file, start, no, record``: the texts of the records, those of a file in
    the order of byte range and number, without the line break that ends them
    and without empty lines.

    A file may begin, end or break anywhere; quotes that are never closed hold
    the rest of the file, as in a read by one task.  Line breaks inside fields
    stay as they are.
    """
    lines = _lines(spark, paths)
    inside = spark.sparkContext.broadcast(frozenset(_ranges_open_at_start(lines)))

    def records(batches):
        now, parts, no, kind, is_open = None, [], 0, WHOLE, False
        out: list[tuple] = []

        def emit(ended: bool):
            nonlocal no
            text = "\n".join(parts)
            if ended and text.endswith("\r"):
                text = text[:-1]
            if text or not ended or kind == HEAD:
                out.append((*now, no, (WHOLE if kind == WHOLE else HEAD) if ended
                            else (TAIL if kind == WHOLE else MIDDLE), text))
                no += 1

        def batch():
            cols = list(zip(*out, strict=True)) or [[]] * 5
            out.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(
                cols, (pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.string()), strict=True)],
                ["file", "start", "no", "kind", "record"])

        for b in batches:
            for file, start, line in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if (file, start) != now:
                    if is_open:
                        emit(False)
                    now, parts, no = (file, start), [], 0
                    is_open = _range_key(file, start) in inside.value
                    kind = HEAD if is_open else WHOLE
                parts.append(line)
                is_open = open_after(line, is_open)
                if not is_open:
                    emit(True)
                    parts, kind = [], WHOLE
            yield batch()
        if is_open:
            emit(False)
        yield batch()

    found = lines.mapInArrow(records, "file string, start long, no long, kind int, record string")
    whole = found.where(F.col("kind") == WHOLE)
    edges = found.where(F.col("kind") != WHOLE)
    order = Window.partitionBy("file").orderBy("start", "no")        # two rows a range at most
    edges = edges.withColumn("at", F.sum((F.col("kind") == TAIL).cast("int")).over(order))
    joined = edges.groupBy("file", "at").agg(
        F.min(F.struct("start", "no")).alias("first"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("start", "no", "record"))),
                                 lambda x: x["record"]), "\n").alias("record"))
    return whole.select("file", "start", "no", "record").union(
        joined.select("file", "first.start", "first.no", "record"))
