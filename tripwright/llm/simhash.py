"""SimHash near-duplicates with vantage-point trees over Hamming distance.

Fingerprints are collapsed to distinct values first, so a group of copies of
any size is one point.  A top vantage-point tree (from a bounded sample) deals
the points to shards: a node keeps points within its median radius on the
inner side and the others on the outer side; points that are outside by no
more than the link distance go to both.  If two points link, one of the two
sides always has both (triangle inequality), so every pair meets in a shard.
Each shard builds its own vantage-point tree by the same rule down to small
leaves, compares exactly there, and emits a spanning star of what it linked -
never all pairs.  A distributed component search joins the stars.
"""

from __future__ import annotations

from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from .common import connected, drop, marks, save

SHINGLE = 3            # words per shingle
MAX_BITS = 2           # fingerprints this close link
SEED = 42
SHARD = 32_768         # distinct fingerprints per shard aimed at
MAX_DEPTH = 16         # of the top tree; beyond 2^16 times SHARD points shards grow
SAMPLE_PER_SHARD = 64  # sampled fingerprints per shard of the top tree
SAMPLE_MIN = 20_000    # and at least these: with MAX_DEPTH at most 2^22 longs (32 MB)
LEAF = 96              # points compared directly


def _bit_counts(digests: bytes) -> np.ndarray:
    """Set bits per position (most significant first) of 8-byte digests."""
    total = np.zeros(64, np.int64)
    rows = np.frombuffer(digests, np.uint8).reshape(-1, 8)
    for i in range(0, len(rows), 255 * 128):
        bits = np.unpackbits(rows[i:i + 255 * 128], axis=1)
        pad = -len(bits) % 255
        if pad:
            bits = np.vstack([bits, np.zeros((pad, 64), np.uint8)])
        total += bits.reshape(-1, 255, 64).sum(axis=1, dtype=np.uint8).sum(axis=0, dtype=np.int64)
    return total


def fingerprint_of(text: bytes | None, shingle: int = SHINGLE) -> int:
    """Signed 64-bit SimHash of one UTF-8 text (none or no word: 0)."""
    from xxhash import xxh64_digest
    words = (text or b"").lower().split()      # bytes: ASCII case and white space only
    if not words:
        return 0
    if len(words) < shingle:
        grams = [b" ".join(words)]
    else:
        grams = map(b" ".join, zip(*(words[i:] for i in range(shingle)), strict=False))
    digests = b"".join(map(xxh64_digest, grams, repeat(SEED)))
    bits = 2 * _bit_counts(digests) > len(digests) // 8
    return int(np.packbits(bits).view(">i8")[0])


def fingerprints(text, shingle: int = SHINGLE):
    """Column of fingerprints (long) of a text column."""
    @arrow_udf("long")
    def fp(texts: pa.Array) -> pa.Array:
        binary = pa.large_binary() if pa.types.is_large_string(texts.type) else pa.binary()
        return pa.array([fingerprint_of(t.as_py(), shingle) for t in texts.cast(binary)], pa.int64())
    return fp(text)


# ---- vantage-point trees -------------------------------------------------------

def _distance(points: np.ndarray, centre) -> np.ndarray:
    return np.bitwise_count(points ^ centre)


def _vantage(points: np.ndarray) -> tuple[np.uint64, int]:
    """A vantage point and its radius: of a few points spread over the sorted
    input, the one with the most even split."""
    best = None
    for centre in points[np.linspace(0, len(points) - 1, 5).astype(np.int64)]:
        d = _distance(points, centre)
        mu = int(np.median(d))
        inner = int((d <= mu).sum())
        score = abs(2 * inner - len(points))
        if best is None or score < best[0]:
            best = (score, centre, mu)
    return best[1], best[2]


def top_tree(sample: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Heap-ordered vantage points and radii of a tree with 2**depth leaves.
    A node without sampled points gets radius 64: all its points go inside."""
    centres = np.zeros((1 << depth) - 1, np.uint64)
    radii = np.full((1 << depth) - 1, 64, np.int16)
    at = {0: np.sort(sample)}
    for node in range(len(centres)):
        points = at.pop(node, np.zeros(0, np.uint64))
        if len(points) < 2:
            continue
        centres[node], radii[node] = _vantage(points)
        inner = _distance(points, centres[node]) <= radii[node]
        at[2 * node + 1], at[2 * node + 2] = points[inner], points[~inner]
    return centres, radii


def route(points: np.ndarray, centres, radii, depth: int, reach: int):
    """``(index, shard)`` of each point: its own shard and those whose inner
    side begins within ``reach``."""
    index, node = np.arange(len(points)), np.zeros(len(points), np.int64)
    for _ in range(depth):
        d = _distance(points[index], centres[node]).astype(np.int16)
        inside, outside = d <= radii[node] + reach, d > radii[node]
        index = np.concatenate([index[inside], index[outside]])
        node = np.concatenate([2 * node[inside] + 1, 2 * node[outside] + 2])
    return index, node - ((1 << depth) - 1)


def close_groups(points: np.ndarray, reach: int, leaf: int = LEAF) -> np.ndarray:
    """Group label (smallest index) per point, where points within ``reach``
    bits link; exact, by a vantage-point tree over distinct points."""
    parent = np.arange(len(points))

    def find(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    todo = [np.argsort(points, kind="stable")]
    while todo:
        index = todo.pop()
        mine = points[index]
        if len(index) > leaf:
            centre, mu = _vantage(mine)
            d = _distance(mine, centre).astype(np.int16)
            inside, outside = index[d <= mu + reach], index[d > mu]
            if len(inside) < len(index) and len(outside) < len(index):
                todo += [inside, outside]
                continue
        # A leaf, or a ball that no vantage point splits.
        for i in range(0, len(index), 1024):
            close = _distance(mine[i:i + 1024, None], mine[None, :]) <= reach
            a, b = np.nonzero(close)
            a = a + i
            for x, y in zip(index[a[a < b]], index[b[a < b]], strict=True):
                x, y = find(x), find(y)
                if x != y:
                    parent[max(x, y)] = min(x, y)
    for i in range(len(parent)):
        parent[i] = parent[parent[i]]
    return parent


def links(distinct: DataFrame, reach: int = MAX_BITS, shard: int = SHARD) -> DataFrame:
    """Spanning links ``(u, v)`` between distinct fingerprints (column ``fp``)
    that join exactly the pairs within ``reach`` bits."""
    n = distinct.count()
    depth = min(MAX_DEPTH, max(0, int(np.ceil(np.log2(max(1, n) / shard)))))
    sample = distinct.orderBy(F.xxhash64("fp"), "fp").limit(
        max(SAMPLE_MIN, SAMPLE_PER_SHARD << depth)) if depth else distinct.limit(0)
    points = sample.select("fp").toArrow().column(0).to_numpy().astype(np.int64).view(np.uint64)
    tree = distinct.sparkSession.sparkContext.broadcast(top_tree(points, depth))

    def deal(batches):
        centres, radii = tree.value
        for b in batches:
            fp = b.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            index, to = route(fp.view(np.uint64), centres, radii, depth, reach)
            yield pa.RecordBatch.from_arrays([pa.array(to), pa.array(fp[index])], ["shard", "fp"])

    def search(table: pa.Table) -> pa.Table:
        fp = np.sort(table.column("fp").to_numpy())
        label = close_groups(fp.view(np.uint64), reach)
        moved = label != np.arange(len(fp))
        return pa.table({"u": fp[moved], "v": fp[label[moved]]})

    return (distinct.select("fp").mapInArrow(deal, "shard long, fp long")
            .groupBy("shard").applyInArrow(search, "u long, v long"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """One row per input row: the id, ``fingerprint`` (16 hex digits) and
    ``component_id``, the smallest id reachable over links of at most
    ``max_bits`` differing bits.

    Null and empty texts have fingerprint zero and link like any other; repeated
    rows repeat in the result; a null id is never the smallest unless its
    component has no other; an empty table gives an empty result.  Columns other
    than the two named are not read.
    """
    rows = save(docs.select(F.col(id_col).alias("id"),
                            fingerprints(F.col(text_col), shingle).alias("fp")), "fingerprints")
    # Written, so that both sides are plain shuffles and a fingerprint of many rows can be split.
    found = save(components(rows, max_bits).select("fp", "component_id"), "components")
    return rows.join(found, "fp").select(
        F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        "component_id")


def components(rows: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """``(fp, root, component_id)`` of every distinct fingerprint of ``(id, fp)``:
    the component's smallest fingerprint and smallest id."""
    distinct = save(rows.groupBy("fp").agg(F.min("id").alias("first_id")), "distinct")
    linked = connected(links(distinct, max_bits))
    least = (linked.join(distinct, linked.node == distinct.fp)
             .groupBy("root").agg(F.min("first_id").alias("low")))
    to = linked.join(least, "root").select("node", "root", "low")
    return distinct.join(to, distinct.fp == to.node, "left").select(
        "fp", F.coalesce("root", "fp").alias("root"),
        F.when(F.col("node").isNull(), F.col("first_id")).otherwise(F.col("low")).alias("component_id"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """One row of each component stays, with all its columns: the one with the
    smallest id, of rows that share it the one with the smallest hash over all
    columns.  A component with null ids only keeps one row as well.  Components
    are told apart by their smallest member fingerprint.
    """
    columns = [F.col(f"`{f.name}`") for f in docs.schema.fields
               if f.dataType.typeName() not in ("map", "variant")]
    mark = marks(*columns)
    rows = save(docs.select(F.col(id_col).alias("id"), mark[0].alias("r1"), mark[1].alias("r2"),
                            fingerprints(F.col(text_col), shingle).alias("fp")), "fingerprints")
    assigned = save(components(rows.select("id", "fp"), max_bits).select("fp", "root"), "components")
    keep = (rows.join(assigned, "fp").groupBy("root")
            .agg(F.min(F.struct(F.col("id").isNull().alias("no"), "id", "r1", "r2")).alias("best"))
            .select("best.r1", "best.r2"))
    keep = save(keep, "survivors")
    drop(rows, assigned)
    marked = docs.withColumns({"__r1": mark[0], "__r2": mark[1]})
    kept = marked.join(keep, (marked["__r1"] == keep["r1"]) & (marked["__r2"] == keep["r2"]), "left_semi")
    return kept.dropDuplicates(["__r1", "__r2"]).drop("__r1", "__r2")
