"""Filter interaction audit: what five filters remove together and alone.

Every text is read once, for a bit per filter that looks at one document and a
SHA-256.  Exact copies need the whole table: a counting Bloom sketch of the
digests is built in each task, merged by slices and sent out; a text one of whose
counters stands at 1 occurs once and is cleared.  Only the rest are shuffled, by
digest, for the smallest id of each text.  Documents with an earlier copy then
move from their mask to the one with the copy bit, as counts to add.
"""

from __future__ import annotations

from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import drop, save

FILTERS = "ABCDE"
MIN_WORDS = 200
MIN_DISTINCT_PERCENT = 50
MAX_UPPER_PERCENT = 3
BLANKS = r"[\x20\x09-\x0D]+"
SYMBOLS = r"[#$%&*|]"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
COPY = 1 << FILTERS.index("E")

HASHES = 3
COUNTERS_PER_ROW = 8
LEAST_COUNTERS, MOST_COUNTERS = 1 << 16, 1 << 27     # two bits each: 32 MB at most
SLICE = 1 << 16                                      # counters of a slice
SKETCH_TASKS = 64                                    # sketches merged at most


# ---- flags of single documents ----------------------------------------------------

def text_mask(text: Column) -> Column:
    """Bits of the filters A to D for a text without nulls."""
    words = F.array_remove(F.split(text, BLANKS, -1), "")
    n = F.size(words)
    upper = F.length(text) - F.length(F.translate(text, UPPER, ""))
    fails = (n < MIN_WORDS,
             100 * F.size(F.array_distinct(words)) < MIN_DISTINCT_PERCENT * n,
             100 * upper.cast("long") > MAX_UPPER_PERCENT * F.length(text).cast("long"),
             text.rlike(SYMBOLS))
    return sum((F.when(f, F.lit(1 << i)).otherwise(0) for i, f in enumerate(fails)), F.lit(0))


def flagged(docs: DataFrame, id_col: str, text_col: str, part_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(part_col), F.lit("")).alias("part"),
                       text_mask(text).alias("mask"), F.unhex(F.sha2(text, 256)).alias("digest"))


# ---- counting Bloom sketch ----------------------------------------------------------

def counters_for(rows: int) -> int:
    """Counters of a sketch for ``rows`` texts: a power of two, bounded.  Beyond
    the bound fewer texts are cleared; the exact step decides them all the same."""
    n = LEAST_COUNTERS
    while n < COUNTERS_PER_ROW * rows and n < MOST_COUNTERS:
        n *= 2
    return n


def slots(digests: pa.Array, counters: int) -> np.ndarray:
    """The counters of each digest, a row of ``HASHES`` numbers."""
    words = np.frombuffer(b"".join(digests.to_pylist()), np.uint64).reshape(len(digests), 4)
    return (words[:, :HASHES] & np.uint64(counters - 1)).astype(np.int64)


def pack(values: np.ndarray) -> bytes:
    v = values.reshape(-1, 4)
    return (v[:, 0] | v[:, 1] << 2 | v[:, 2] << 4 | v[:, 3] << 6).astype(np.uint8).tobytes()


def unpack(data: bytes) -> np.ndarray:
    b = np.frombuffer(data, np.uint8)
    return np.stack([b >> s & 3 for s in (0, 2, 4, 6)], axis=1).reshape(-1)


def merged_sketch(digests: DataFrame, counters: int) -> bytes:
    """The packed counters (0, 1, 2 = more) of all rows of the one binary column:
    a sketch per task, added slice by slice."""
    def count(batches):
        seen = np.zeros(counters, np.uint8)
        for b in batches:
            at, n = np.unique(slots(b.column(0), counters), return_counts=True)
            seen[at] = np.minimum(seen[at] + np.minimum(n, 2), 2)
        kept = [(i, pack(part)) for i, part in enumerate(seen.reshape(-1, SLICE)) if part.any()]
        yield pa.RecordBatch.from_arrays([pa.array([i for i, _ in kept], pa.int32()),
                                          pa.array([p for _, p in kept], pa.binary())], ["slice", "counts"])

    def add(table: pa.Table) -> pa.Table:
        total = np.zeros(SLICE, np.uint8)
        for c in table.column("counts"):
            total = np.minimum(total + unpack(c.as_py()), 2)
        return pa.table({"slice": table.column("slice")[:1], "counts": pa.array([pack(total)], pa.binary())})

    own = digests.coalesce(SKETCH_TASKS).mapInArrow(count, "slice int, counts binary")
    out = bytearray(counters // 4)
    for r in own.groupBy("slice").applyInArrow(add, "slice int, counts binary").toLocalIterator():
        out[r["slice"] * SLICE // 4:(r["slice"] + 1) * SLICE // 4] = r["counts"]
    return bytes(out)


def possible_repeats(rows: DataFrame) -> DataFrame:
    """The rows whose ``digest`` the sketch of all rows can't clear as unique."""
    spark = rows.sparkSession
    counters = counters_for(rows.count())
    sketch = spark.sparkContext.broadcast(merged_sketch(rows.select("digest"), counters))    # bounded above

    def look(batches):
        counts = np.frombuffer(sketch.value, np.uint8)
        for b in batches:
            at = slots(b.column("digest"), counters)
            seen = counts[at >> 2] >> (2 * (at & 3)).astype(np.uint8) & 3
            yield b.filter(pa.array((seen > 1).all(axis=1)))

    return rows.mapInArrow(look, rows.schema)


def later_copies(rows: DataFrame) -> DataFrame:
    """The rows whose digest a row of a smaller id has too.  Written tables on
    both sides of the join let adaptive execution split a digest of many rows."""
    maybe = save(possible_repeats(rows), "possible-repeats")
    first = save(maybe.groupBy("digest").agg(F.min("id").alias("first"), F.count("*").alias("n"))
                 .where("n > 1").select("digest", "first"), "first-copies")
    later = save(maybe.join(first, "digest").where(F.col("id") > F.col("first"))
                 .select("id", "part", "mask"), "later-copies")
    drop(maybe, first)
    return later


# ---- counts and audit -----------------------------------------------------------------

def mask_counts(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                part_col: str = "lang") -> DataFrame:
    """Documents by ``part`` and ``mask`` (bit i set: filter i fails): ``n``, and
    of these ``good`` (a label of quality 1) and ``toxic`` (a label of toxic 1)."""
    rows = save(flagged(docs, id_col, text_col, part_col), "flags")
    later = later_copies(rows)
    moves = [later.select("id", "part", (F.col("mask") + add).alias("mask"), F.lit(n).alias("n"))
             for add, n in ((COPY, 1), (0, -1))]
    signed = rows.select("id", "part", "mask", F.lit(1).alias("n")).union(moves[0]).union(moves[1])
    known = (labels.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("id"))
             .agg(*[F.max(F.when(F.col(c) == 1, 1).otherwise(0)).alias(a)
                    for c, a in (("quality", "good"), ("toxic", "toxic"))]).where("good + toxic > 0"))
    zero = F.lit(0).cast("long")
    counts = (signed.groupBy("part", "mask").agg(F.sum("n").alias("n")).withColumns({"good": zero, "toxic": zero})
              .union(signed.join(known, "id").groupBy("part", "mask").agg(
                  zero.alias("n"), F.sum(F.col("n") * F.col("good")).alias("good"),
                  F.sum(F.col("n") * F.col("toxic")).alias("toxic"))))
    out = save(counts.groupBy("part", "mask").agg(*[F.sum(c).alias(c) for c in ("n", "good", "toxic")]),
               "mask-counts")
    drop(rows, later)
    return out


def audit(counts: DataFrame) -> DataFrame:
    """The report of :func:`interactions` from ``mask_counts``: at most 32 masks
    a part, gone through for each order and step."""
    orders = ["".join(p) for p in permutations(FILTERS)]
    shares = [len(orders) // k for k in range(1, len(FILTERS) + 1)]
    cells = counts.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("cells"))
    rows = (cells.withColumn("filter_order", F.explode(F.lit(orders)))
            .withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(len(FILTERS))))))

    def bits(letters: Column) -> Column:
        return sum((F.when(F.contains(letters, F.lit(x)), F.lit(1 << i)).otherwise(0)
                    for i, x in enumerate(FILTERS)), F.lit(0))

    rows = rows.select("*", bits(F.substring("filter_order", F.col("step"), F.lit(1))).alias("own"),
                       bits(F.substring("filter_order", F.lit(1), F.col("step") - 1)).alias("before"))
    own, before = F.col("own"), F.col("before")

    def total(value, when) -> Column:
        return F.aggregate("cells", F.lit(0).cast("long"), lambda acc, c: acc + F.when(
            when(c["mask"]), value(c)).otherwise(0))

    def n(c):
        return c["n"]

    def fails(m):
        return m.bitwiseAND(own) != 0

    def alive(m):
        return m.bitwiseAND(before) == 0

    removed = lambda m: fails(m) & alive(m)
    return rows.select(
        "part", "filter_order", "step",
        total(n, lambda m: alive(m) & ~fails(m)).alias("kept"),
        total(n, removed).alias("removed"),
        total(n, lambda m: fails(m) & ~alive(m)).alias("redundant"),
        total(n, lambda m: m == own).alias("unique_fails"),
        total(lambda c: c["good"], removed).alias("good_lost"),
        total(lambda c: c["toxic"], removed).alias("toxic_lost"),
        # Of k failing filters each comes first in a k-th of the orders.
        total(lambda c: c["n"] * F.get(F.lit(shares), F.bit_count(c["mask"]) - 1), fails).alias("shapley"))


def interactions(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 part_col: str = "lang") -> DataFrame:
    """Per part, order of the filters and step: documents kept, removed and so on.

    A: under 200 words; B: under half of the words distinct; C: over 3 % of the
    code points are A-Z; D: holds a symbol of ``#$%&*|``; E: the text of a smaller
    id, wherever that is.  A null text is an empty one; a null part is the part
    ''; a null id is no smaller id and none is smaller than it; rows of one id
    are documents of their own and no copies of each other; of several labels of
    an id any 1 counts; labels without a document count nowhere; an empty table
    gives an empty result.  Only the named columns are read.
    """
    return audit(mask_counts(docs, labels, id_col, text_col, part_col))


INTERACTIONS_SQL = rf"""
WITH worded AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS body,
         list_filter(string_split_regex(coalesce(text, ''), '{BLANKS}'), lambda w: w <> '') AS ws
  FROM documents),
failing AS (
  SELECT doc_id, part,
         [len(ws) < {MIN_WORDS}, 100 * len(list_distinct(ws)) < {MIN_DISTINCT_PERCENT} * len(ws),
          100 * length(regexp_replace(body, '[^A-Z]', '', 'g')) > {MAX_UPPER_PERCENT} * length(body),
          regexp_matches(body, '{SYMBOLS}'),
          coalesce(doc_id > min(doc_id) OVER (PARTITION BY body), false)] AS f
  FROM worded),
docs AS (
  SELECT part, f, doc_id IN (SELECT doc_id FROM labels WHERE quality = 1) AS good,
         doc_id IN (SELECT doc_id FROM labels WHERE toxic = 1) AS toxic
  FROM failing),
cells AS (
  SELECT part, f, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic
  FROM docs GROUP BY part, f),
five AS (SELECT unnest([1, 2, 3, 4, 5]) AS i),
orders AS (
  SELECT [a.i, b.i, c.i, d.i, e.i] AS o FROM five a, five b, five c, five d, five e
  WHERE len(list_distinct([a.i, b.i, c.i, d.i, e.i])) = 5),
steps AS (
  SELECT array_to_string(list_transform(o, lambda k: substr('{FILTERS}', k, 1)), '') AS filter_order,
         s.i AS step, o[s.i] AS own, o[1:s.i - 1] AS before
  FROM orders, five s),
counted AS (
  SELECT part, filter_order, step, own, n, good, toxic, f[own] AS fails,
         len(list_filter(before, lambda k: f[k])) = 0 AS alive,
         len(list_filter(f, lambda b: b)) = 1 AS alone
  FROM cells, steps),
report AS (
  SELECT part, filter_order, step::INTEGER AS step, any_value(own) AS own,
         coalesce(sum(n) FILTER (alive AND NOT fails), 0)::BIGINT AS kept,
         coalesce(sum(n) FILTER (alive AND fails), 0)::BIGINT AS removed,
         coalesce(sum(n) FILTER (fails AND NOT alive), 0)::BIGINT AS redundant,
         coalesce(sum(n) FILTER (fails AND alone), 0)::BIGINT AS unique_fails,
         coalesce(sum(good) FILTER (alive AND fails), 0)::BIGINT AS good_lost,
         coalesce(sum(toxic) FILTER (alive AND fails), 0)::BIGINT AS toxic_lost
  FROM counted GROUP BY part, filter_order, step)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       (sum(removed) OVER (PARTITION BY part, own))::BIGINT AS shapley
FROM report
"""
