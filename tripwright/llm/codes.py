"""Vector code compression: product quantization by ball k-means, in integers.

A vector's components are floors of ``SCALE`` times the value; it is cut into
equal parts and each part position has a codebook of its own.  A part's entry
moves little from round to round, so a round starts from the entry of the round
before: the parts of an entry lie in a ball around it, and only entries whose
half distance is within the ball's radius are neighbours.  A part nearer to its
entry than half the way to the nearest neighbour is in the stable core and keeps
it; one further out is in a ring, whose number says how many neighbours are
compared exactly.  Distances are integers, so every bound is exact.

Rows stay where they are: a round is one pass over them, and what leaves a task
is a sum per part, entry and component.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import drop, save

PARTS = 16
ENTRIES = 64
ROUNDS = 2
SCALE = 256
#: Bound of a scaled component: squared distances of up to 4,096 of them fit a long.
LIMIT = 1 << 24


@dataclass(frozen=True)
class Codebooks:
    """``entries[part, entry, component]`` and, from the second round on, bounds
    on the ball of each entry: ``reach[part, entry]`` is at least the distance of
    any of its parts."""
    entries: np.ndarray
    reach: np.ndarray | None = None

    def digest(self) -> str:
        return hashlib.sha256(",".join(map(str, self.entries.reshape(-1).tolist())).encode()).hexdigest()


# ---- rows to integers ---------------------------------------------------------------

def scaled(vectors: DataFrame, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    """``id, label, v``: vectors without a null or non-finite component, as
    integers."""
    x = F.transform(F.col(vector_col), lambda c: c.cast("double"))
    usable = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != F.lit(float("inf"))))
    floor = F.transform(x, lambda c: F.greatest(F.least(F.floor(F.greatest(F.least(
        c * SCALE, F.lit(float(LIMIT))), F.lit(float(-LIMIT)))), F.lit(LIMIT)), F.lit(-LIMIT)).cast("int"))
    # The condition stays with the row: a filter below would be evaluated on nulls.
    return vectors.select(F.col(id_col).alias("id"), F.col(label_col).alias("label"),
                          F.when(usable, floor).alias("v")).where(F.col("v").isNotNull())


def matrix(column: pa.Array, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, dims)


# ---- assignment of a batch ------------------------------------------------------------

def distances(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact squared distances of the rows of ``x`` to those of ``c``."""
    if max(np.abs(x).max(initial=0), np.abs(c).max(initial=0)) ** 2 * 4 * x.shape[1] < 1 << 52:
        x, c = x.astype(np.float64), c.astype(np.float64)        # integers that doubles hold
        d = (x * x).sum(1)[:, None] - 2 * (x @ c.T) + (c * c).sum(1)
        return d.astype(np.int64)
    return sum((x[:, k, None] - c[None, :, k]) ** 2 for k in range(x.shape[1]))


def nearest(x: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    d = distances(x, c)
    at = d.argmin(1)             # of ties the lowest
    return at, d[np.arange(len(x)), at]


def neighbours(c: np.ndarray, reach: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per entry the entries that can be as near to a part of its ball as itself,
    nearest first, and their squared distances."""
    between = distances(c, c)
    out = []
    for i, d in enumerate(between):
        near = np.nonzero(d <= 4 * int(reach[i]) ** 2)[0]
        near = near[near != i]
        near = near[np.argsort(d[near], kind="stable")]
        out.append((near, d[near]))
    return out


def ball_step(x: np.ndarray, before: np.ndarray, c: np.ndarray, near: list) -> tuple[np.ndarray, np.ndarray]:
    """Entry and squared distance of each part, from the entry it had.  Another
    entry at distance b from its own can't be nearer, nor tie, while 4 d² < b²."""
    at, best = before.copy(), np.zeros(len(x), np.int64)
    order = np.argsort(before, kind="stable")
    bounds = np.searchsorted(before[order], np.arange(len(c) + 1))
    for i in range(len(c)):
        rows = order[bounds[i]:bounds[i + 1]]
        if not len(rows):
            continue
        own = ((x[rows] - c[i]) ** 2).sum(1)
        best[rows] = own
        entries, between = near[i]
        ring = np.searchsorted(between, 4 * own, side="right")     # entries with b² <= 4 d²
        out = ring > 0                                             # the rest is the stable core
        if not out.any():
            continue
        rows, own, ring = rows[out], own[out], ring[out]
        tried = entries[:ring.max()]
        d = distances(x[rows], c[tried])
        d[np.arange(len(tried)) >= ring[:, None]] = np.iinfo(np.int64).max
        low = d.min(1)
        index = np.where(d == low[:, None], tried, len(c)).min(1)
        moves = (low < own) | ((low == own) & (index < i))
        at[rows[moves]], best[rows[moves]] = index[moves], low[moves]
    return at, best


# ---- rounds ------------------------------------------------------------------------------

def assign(rows: DataFrame, books: Codebooks, dims: int, first: bool) -> DataFrame:
    """``rows`` with the entry of each part (``code``, a byte each) and the
    squared distances summed (``error``)."""
    entries, width = books.entries, dims // len(books.entries)
    near = None if first else [neighbours(c, r) for c, r in zip(entries, books.reach, strict=True)]

    def run(batches):
        for b in batches:
            v = matrix(b.column("v"), dims)
            code, error = np.zeros((len(v), len(entries)), np.uint8), np.zeros(len(v), np.int64)
            if not first:
                before = np.frombuffer(b"".join(b.column("code").to_pylist()), np.uint8).reshape(code.shape)
            for p, c in enumerate(entries):
                x = v[:, p * width:(p + 1) * width]
                at, d = nearest(x, c) if first else ball_step(x, before[:, p].astype(np.int64), c, near[p])
                code[:, p] = at
                error += d
            yield pa.RecordBatch.from_arrays(
                [b.column("id"), b.column("label"), b.column("v"),
                 pa.array([r.tobytes() for r in code], pa.binary()), pa.array(error)],
                ["id", "label", "v", "code", "error"])

    kinds = dict(rows.dtypes)
    return rows.mapInArrow(run, f"id {kinds['id']}, label {kinds['label']}, v array<int>, code binary, error long")


def moved(rows: DataFrame, books: Codebooks, dims: int) -> Codebooks:
    """Entries replaced by the floor of their parts' mean, with the reach of each
    ball around its new place: the furthest part's distance from the old place,
    and the way between the two.  At most ``PARTS * ENTRIES`` sums of ``dims /
    PARTS`` numbers reach the driver."""
    entries = books.entries
    parts, n, width = entries.shape

    def sums(batches):
        total, number = np.zeros(entries.shape, np.int64), np.zeros((parts, n), np.int64)
        far = np.zeros((parts, n), np.int64)
        for b in batches:
            v = matrix(b.column("v"), dims)
            code = np.frombuffer(b"".join(b.column("code").to_pylist()), np.uint8).reshape(len(v), parts)
            for p in range(parts):
                x, at = v[:, p * width:(p + 1) * width], code[:, p]
                np.add.at(total[p], at, x)
                number[p] += np.bincount(at, minlength=n)
                np.maximum.at(far[p], at, ((x - entries[p][at]) ** 2).sum(1))
        p, e = np.nonzero(number)
        yield pa.RecordBatch.from_arrays(
            [pa.array(p, pa.int32()), pa.array(e, pa.int32()), pa.array(list(total[p, e]), pa.list_(pa.int64())),
             pa.array(number[p, e]), pa.array(far[p, e])], ["part", "entry", "total", "n", "far"])

    each = rows.select("v", "code").mapInArrow(sums, "part int, entry int, total array<long>, n long, far long")
    got = each.groupBy("part", "entry").agg(
        F.array(*[F.sum(F.get("total", F.lit(k))) for k in range(width)]).alias("total"),
        F.sum("n").alias("n"), F.max("far").alias("far")).toLocalIterator()
    after, reach = entries.copy(), np.zeros((parts, n), np.int64)
    for r in got:
        p, e = r["part"], r["entry"]
        after[p, e] = [t // r["n"] for t in r["total"]]
        way = int(((after[p, e] - entries[p, e]) ** 2).sum())
        reach[p, e] = isqrt(r["far"]) + 1 + isqrt(way) + 1
    return Codebooks(after, reach)


def compress(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
             parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> DataFrame:
    """Id, ``code``, ``error``, ``label_error`` and ``codebooks_sha256`` of every
    kept vector; :func:`codebooks` says how they come about.

    Rows whose vector is null or holds a null or non-finite component are
    dropped, and so are those of another length than the vector of the smallest
    id, or of a length that the parts don't divide.  Components beyond
    ``LIMIT`` after scaling count as it.  Codebooks start with the smallest
    distinct ids, a null one never being among them, and of several rows of an
    id the smallest vector; there may be fewer than ``entries`` of them.
    Otherwise repeated rows and null ids are rows like any other; null labels
    are one label; without a kept id the result is empty.  Sums of a label that
    no long holds stand at the largest.  Only the named columns are read.
    """
    rows, books = codebooks(vectors, id_col, vector_col, label_col, parts, entries, rounds)
    sums = rows.groupBy("label").agg(F.sum(F.col("error").cast("decimal(38,0)")).alias("sum"))
    # Written, so that both sides of the join are plain shuffles and a label of many rows can be split.
    sums = save(sums.select(F.col("label").alias("__label"), F.least(
        F.col("sum"), F.lit(str((1 << 63) - 1)).cast("decimal(38,0)")).cast("long").alias("label_error")), "label-errors")
    return rows.join(sums, F.col("label").eqNullSafe(F.col("__label"))).select(
        F.col("id").alias(id_col), F.lower(F.hex("code")).alias("code"), "error", "label_error",
        F.lit(books.digest()).alias("codebooks_sha256"))


def codebooks(vectors: DataFrame, id_col: str, vector_col: str, label_col: str, parts: int = PARTS,
              entries: int = ENTRIES, rounds: int = ROUNDS) -> tuple[DataFrame, Codebooks]:
    """The kept rows with their final codes, written, and the codebooks: those of
    the first ``entries`` vectors, after ``rounds`` of assigning each part to the
    nearest entry (of ties the lower) and moving each entry that has parts to
    the floor of their mean."""
    spark = vectors.sparkSession
    rows = save(scaled(vectors, id_col, vector_col, label_col), "scaled")
    first = [r["id"] for r in rows.select("id").where("id is not null").distinct().orderBy("id").limit(entries).collect()]
    chosen = rows.where(F.col("id").isin(first)).groupBy("id").agg(F.min("v").alias("v")).orderBy("id").collect()
    dims = len(chosen[0]["v"]) if chosen else 0
    if not dims or dims % parts:
        empty = spark.createDataFrame([], rows.schema).select("*", F.lit(b"").alias("code"), F.lit(0).cast("long").alias("error"))
        return empty, Codebooks(np.zeros((parts, 0, 0), np.int64))
    start = np.array([r["v"] for r in chosen if len(r["v"]) == dims], np.int64)
    books = Codebooks(np.stack(np.split(start, parts, axis=1)))
    now = rows.where(F.size("v") == dims)
    for turn in range(rounds + 1):
        done = save(assign(now, books, dims, turn == 0), "codes")
        drop(rows if turn == 0 else now)
        now = done
        if turn < rounds:
            books = moved(now, books, dims)
    return now, books


COMPRESS_SQL = f"""
WITH usable AS (
  SELECT vec_id, label, list_transform(embedding, lambda c: floor({SCALE} * c::DOUBLE)::BIGINT) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
cut AS (
  SELECT vec_id, p, v[p * (len(v) // {PARTS}) + 1:(p + 1) * (len(v) // {PARTS})] AS x
  FROM usable, range({PARTS}) AS parts(p)),
e0 AS (
  SELECT p, row_number() OVER (PARTITION BY p ORDER BY vec_id) - 1 AS e, x AS c
  FROM cut WHERE vec_id IN (SELECT vec_id FROM usable ORDER BY vec_id LIMIT {ENTRIES})),
""" + "".join(f"""
a{r} AS (
  SELECT vec_id, p, any_value(x) AS x, min((d, e)) AS got FROM (
    SELECT vec_id, p, x, e, list_sum(list_transform(list_zip(x, c), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS d
    FROM cut JOIN e{r} USING (p)) GROUP BY vec_id, p),
s{r} AS (
  SELECT p, got[2] AS e, i, floor(sum(x[i])::DOUBLE / count(*))::BIGINT AS m
  FROM a{r}, range(1, (SELECT max(len(x)) FROM cut) + 1) AS w(i) GROUP BY ALL),
e{r + 1} AS (
  SELECT p, e, coalesce(list(m ORDER BY i) FILTER (m IS NOT NULL), any_value(c)) AS c
  FROM e{r} LEFT JOIN s{r} USING (p, e) GROUP BY p, e),
""" for r in range(ROUNDS)) + f"""
last AS (
  SELECT vec_id, p, min((d, e)) AS got FROM (
    SELECT vec_id, p, e, list_sum(list_transform(list_zip(x, c), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS d
    FROM cut JOIN e{ROUNDS} USING (p)) GROUP BY vec_id, p),
coded AS (
  SELECT vec_id, string_agg(printf('%02x', got[2]), '' ORDER BY p) AS code, sum(got[1])::BIGINT AS error
  FROM last GROUP BY vec_id),
books AS (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM e{ROUNDS})
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256
FROM coded JOIN usable USING (vec_id), books
"""
