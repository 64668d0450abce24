"""Exact repeated-passage removal by a hash-compared suffix sort.

Which bytes lie in a string of ``LENGTH`` bytes that also starts elsewhere?

1. Anchors.  Each window of ``LENGTH`` bytes selects the ``GRAM`` bytes in it
   with the smallest hash, so equal windows select at the same place.  The
   windows that select one anchor are consecutive; the anchor with the bytes
   they cover is its context.
2. Anchors whose gram occurs once are dropped.  A context that occurs twice
   decides all its windows at once, however often it occurs; only one of each
   different context goes on.
3. The other windows are decided among the contexts of one gram: their suffixes
   are sorted by a mergesort whose comparisons find the common extension by
   binary search over prefix polynomial hashes, and neighbours that agree in
   ``LENGTH`` bytes are verified byte by byte.  Contexts are dealt to tasks by
   gram; a gram with very many different contexts is dealt by the content of
   ever shorter blocks of windows instead, so no task gathers a hot one.
4. Covered bytes are merged per document and cut out.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from .common import drop, marks, save

LENGTH = 200                # bytes of a repeated string
GRAM = 32                   # bytes of an anchor's gram
HOT = 2_000                 # different contexts of a gram sorted by one task
BLOCKS = (16, 4, 1)         # windows per block where there are more
BUCKET_BYTES = 3_000_000    # of contexts sorted together, about
STEP = 1 << 20              # windows selected at once

MIX = np.uint64(0x9E3779B97F4A7C15)
BASE = np.uint64(0xD6E8FEB86659FD93)          # odd
BASE_INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))


# ---- 1. anchors -------------------------------------------------------------------

def _gram_hashes(data: np.ndarray) -> np.ndarray:
    """Hash of the ``GRAM`` bytes from each place (``GRAM`` a power of two)."""
    h, size = (data.astype(np.uint64) + np.uint64(1)) * MIX, 1
    while size < GRAM:
        h = h[:-size] * np.uint64(pow(int(BASE), size, 1 << 64)) + h[size:]
        size *= 2
    h = (h ^ (h >> np.uint64(29))) * MIX
    return h ^ (h >> np.uint64(32))


def _sliding_argmin(key: np.ndarray, w: int) -> np.ndarray:
    """Place of the smallest key (leftmost of equal ones) in each run of ``w``."""
    n = len(key)
    places = np.arange(n, dtype=np.uint64)
    packed = (key >> np.uint64(21) << np.uint64(21)) | places      # n < 2**21
    pad = -n % w
    blocks = np.concatenate([packed, np.full(pad, np.uint64(2**64 - 1))]).reshape(-1, w)
    left = np.minimum.accumulate(blocks, axis=1).reshape(-1)
    right = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    least = np.minimum(right[:n - w + 1], left[w - 1:n])
    return (least & np.uint64((1 << 21) - 1)).astype(np.int64)


def anchors_of(text: bytes, length: int = LENGTH):
    """Arrays (gram hash, anchor, first window, last window) of one text; every
    window of the text belongs to exactly one of them."""
    data = np.frombuffer(text, np.uint8)
    windows, w = len(data) - length + 1, length - GRAM + 1
    parts = []
    for i in range(0, windows, STEP):
        h = _gram_hashes(data[i:min(i + STEP, windows) + length - 1])
        at = _sliding_argmin(h, w)
        first = np.concatenate([[0], np.nonzero(np.diff(at))[0] + 1])
        last = np.concatenate([first[1:] - 1, [len(at) - 1]])
        parts.append((h[at[first]].view(np.int64), at[first] + i, first + i, last + i))
    return [np.concatenate(x) for x in zip(*parts, strict=True)] if parts else [np.zeros(0, np.int64)] * 4


ANCHORS = "k1 long, k2 long, gram long, context binary, at int, low int, high int"


def anchors(rows: DataFrame, length: int = LENGTH) -> DataFrame:
    """Anchors of all texts of ``(k1, k2, text)``.  A context is told by 128 bits
    of a cryptographic digest of all its bytes: contexts equal in it are removed
    without being compared again."""
    def run(batches):
        for b in batches:
            k1, k2 = b.column(0).to_numpy(), b.column(1).to_numpy()
            out, owner, contexts = [], [], []
            for i, t in enumerate(b.column(2)):
                text = t.as_py() or b""
                if len(text) < length:
                    continue
                gram, at, low, high = anchors_of(text, length)
                contexts += [hashlib.blake2b(text[x:y + length], digest_size=16).digest()
                             for x, y in zip(low.tolist(), high.tolist(), strict=True)]
                out.append((gram, at, low, high))
                owner.append(np.full(len(gram), i))
            if not out:
                continue
            gram, at, low, high = (np.concatenate(x) for x in zip(*out, strict=True))
            owner = np.concatenate(owner)
            yield pa.RecordBatch.from_arrays(
                [pa.array(x) for x in (k1[owner], k2[owner], gram)] + [pa.array(contexts, pa.binary())]
                + [pa.array(x.astype(np.int32)) for x in (at, low, high)],
                ["k1", "k2", "gram", "context", "at", "low", "high"])
    return rows.select("k1", "k2", F.col("text").cast("binary")).mapInArrow(run, ANCHORS)


# ---- 3. suffix sort -----------------------------------------------------------------

class Suffixes:
    """Suffixes of a buffer, compared over at most ``length`` bytes."""

    def __init__(self, data: np.ndarray, length: int):
        self.data, self.length = data, length
        n = len(data)
        power = np.ones(n + 1, np.uint64)
        inverse = np.ones(n + 1, np.uint64)
        power[1:], inverse[1:] = BASE, BASE_INVERSE
        np.multiply.accumulate(power, out=power)
        np.multiply.accumulate(inverse, out=inverse)
        self.inverse = inverse
        self.prefix = np.zeros(n + 1, np.uint64)
        spread = (np.arange(1, 257, dtype=np.uint64) * MIX)
        spread ^= spread >> np.uint64(31)
        np.cumsum((spread * MIX)[data] * power[:-1], out=self.prefix[1:])

    def hashes(self, at: np.ndarray, size: np.ndarray) -> np.ndarray:
        return (self.prefix[at + size] - self.prefix[at]) * self.inverse[at]

    def common(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Common extension of pairs of suffixes, by binary search."""
        low, high = np.zeros(len(x), np.int64), np.full(len(x), self.length)
        for _ in range(self.length.bit_length()):
            mid = (low + high + 1) >> 1
            same = self.hashes(x, mid) == self.hashes(y, mid)
            low, high = np.where(same, mid, low), np.where(same, high, mid - 1)
        return low

    def less(self, x: np.ndarray, y: np.ndarray, or_equal: np.ndarray) -> np.ndarray:
        n = self.common(x, y)
        inside = n < self.length
        at = np.where(inside, n, 0)
        return np.where(inside, self.data[x + at] < self.data[y + at], or_equal)

    def equal(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Pairs that agree in all ``length`` bytes, verified on the bytes."""
        out = self.common(x, y) == self.length
        view = np.lib.stride_tricks.sliding_window_view(self.data, self.length)
        claimed = np.nonzero(out)[0]
        for i in range(0, len(claimed), 8192):
            part = claimed[i:i + 8192]
            out[part] = (view[x[part]] == view[y[part]]).all(axis=1)
        return out


def merge_sort(order: np.ndarray, group: np.ndarray, suffixes: Suffixes) -> np.ndarray:
    """Sorts the suffixes ``order`` within runs of equal ``group``: bottom-up
    mergesort of all groups at once.  In each merge an element's new place is
    its place in its own run plus its rank in the other, by binary search."""
    order = order.copy()
    starts = np.concatenate([[0], np.nonzero(np.diff(group))[0] + 1])
    sizes = np.diff(np.concatenate([starts, [len(order)]]))
    begin, size = np.repeat(starts, sizes), np.repeat(sizes, sizes)
    place = np.arange(len(order)) - begin
    width = 1
    while width < sizes.max(initial=1):
        block = place // (2 * width) * (2 * width)
        active = np.nonzero(block + width < size)[0]      # blocks with two runs
        if len(active):
            b, p, n, start = block[active], place[active], size[active], begin[active]
            left = p - b < width
            other = start + b + np.where(left, width, 0)
            low = np.zeros(len(active), np.int64)
            high = np.where(left, np.minimum(2 * width, n - b) - width, width)
            mine = order[active]
            for _ in range(width.bit_length()):
                open_ = np.nonzero(low < high)[0]
                if not len(open_):
                    break
                mid = (low[open_] + high[open_]) >> 1
                # Left elements go before equal right ones.
                before = suffixes.less(order[other[open_] + mid], mine[open_], ~left[open_])
                low[open_] = np.where(before, mid + 1, low[open_])
                high[open_] = np.where(before, high[open_], mid)
            own = np.where(left, p - b, p - b - width)
            order[start + b + own + low] = mine
        width *= 2
    return order


def repeated_windows(texts: list[bytes], gram: np.ndarray, offset: np.ndarray, windows: np.ndarray,
                     length: int = LENGTH) -> np.ndarray:
    """Which windows of the contexts are equal to another one: a flag for each
    window, context after context.  ``offset`` is the anchor's place in the
    context; only windows of one gram at one place relative to the anchor can
    be equal."""
    data = np.frombuffer(b"".join(texts), np.uint8)
    sizes = np.array([len(t) for t in texts])
    begin = np.cumsum(sizes) - sizes
    row = np.repeat(np.arange(len(texts)), windows)
    inner = np.arange(len(row)) - np.repeat(np.cumsum(windows) - windows, windows)
    at = begin[row] + inner
    _, number = np.unique(gram, return_inverse=True)
    group = number[row] * np.int64(length) + (offset[row] - inner)
    order = np.argsort(group, kind="stable")
    g = group[order]
    alone = np.ones(len(g), bool)
    alone[1:] &= g[1:] != g[:-1]
    alone[:-1] &= g[:-1] != g[1:]
    order, g = order[~alone], g[~alone]
    found = np.zeros(len(row), bool)
    if not len(order):
        return found
    window_of = np.full(len(data) + 1, -1, np.int64)
    window_of[at] = np.arange(len(at))
    suffixes = Suffixes(data, length)
    ranked = merge_sort(at[order], g, suffixes)
    pairs = np.nonzero(g[1:] == g[:-1])[0]
    same = pairs[suffixes.equal(ranked[pairs], ranked[pairs + 1])]
    found[window_of[ranked[same]]] = True
    found[window_of[ranked[same + 1]]] = True
    return found


def _runs(found: np.ndarray, windows: np.ndarray):
    """(context, first, last) of the runs of flags within each context."""
    row = np.repeat(np.arange(len(windows)), windows)
    inner = np.arange(len(row)) - np.repeat(np.cumsum(windows) - windows, windows)
    hit = np.nonzero(found)[0]
    if not len(hit):
        return (np.zeros(0, np.int64),) * 3
    new = np.concatenate([[True], (np.diff(hit) > 1) | (np.diff(row[hit]) > 0)])
    first = hit[new]
    last = hit[np.concatenate([np.nonzero(new)[0][1:] - 1, [len(hit) - 1]])]
    return row[first], inner[first], inner[last]


SPANS = "k1 long, k2 long, start int, stop int"


def _sorted_spans(contexts: DataFrame, length: int) -> DataFrame:
    """Spans of unresolved contexts, decided among the contexts of their gram."""
    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([("gram", "ascending"), ("k1", "ascending"), ("k2", "ascending"), ("low", "ascending")])
        low, high = (table.column(c).to_numpy().astype(np.int64) for c in ("low", "high"))
        windows = high - low + 1
        found = repeated_windows(table.column("bytes").to_pylist(), table.column("gram").to_numpy(),
                                 table.column("at").to_numpy() - low, windows, length)
        row, first, last = _runs(found, windows)
        alone = table.column("n").to_numpy()[row] == 1
        row, first, last = row[alone], first[alone], last[alone]
        return pa.table({"k1": table.column("k1").to_numpy()[row], "k2": table.column("k2").to_numpy()[row],
                         "start": (low[row] + first).astype(np.int32),
                         "stop": (low[row] + last + length).astype(np.int32)})
    return contexts.groupBy("bucket").applyInArrow(run, SPANS)


def _narrowed_spans(contexts: DataFrame, length: int) -> DataFrame:
    """The same for grams with very many contexts, by content instead of by gram.

    The windows of a context are cut into blocks at fixed places relative to
    the anchor.  A block that occurs twice as a whole is repeated; one whose
    core, the bytes that all its windows share, occurs once has no repeated
    window.  Only blocks between the two, those around the end of a match, are
    cut further, down to single windows.
    """
    spans = None
    rows = contexts.select("k1", "k2", "gram", "at", F.col("low").alias("p0"), F.col("high").alias("p1"),
                           "bytes", (F.col("n") == 1).alias("open"))
    for size in BLOCKS:
        number = lambda p: F.floor((F.col("at") - p) / size).cast("int")
        cut_ = rows.withColumnRenamed("p0", "q0").withColumnRenamed("p1", "q1").select(
            "*", F.explode(F.sequence(number(F.col("q1")), number(F.col("q0")))).alias("b"))
        cut_ = cut_.withColumns({
            "top": F.col("at") - F.col("b") * size, "p0": F.greatest("q0", F.expr(f"at - b * {size} - {size - 1}")),
            "p1": F.least("q1", F.expr(f"at - b * {size}"))})
        cut_ = cut_.select(
            "k1", "k2", "gram", "at", "b", "p0", "p1", "open",
            F.sha2(F.expr(f"substring(bytes, top - q0 + 1, {length - size + 1})"), 256).alias("core"),
            F.expr(f"substring(bytes, p0 - q0 + 1, p1 - p0 + {length})").alias("bytes"))
        cut_ = save(cut_.withColumn("whole", F.sha2("bytes", 256)).withColumn(
            "o", F.col("at") - F.col("p0")), f"blocks-{size}")
        whole = cut_.groupBy("gram", "b", "core", "o", "whole").agg(
            F.count("*").alias("times"), F.min(F.struct("k1", "k2", "p0")).alias("one"))
        core = whole.groupBy("gram", "b", "core").agg(F.sum("times").alias("near"))
        known = cut_.join(whole, ["gram", "b", "core", "o", "whole"])
        found = known.where("open and times > 1").select(
            "k1", "k2", F.col("p0").alias("start"), (F.col("p1") + length).alias("stop"))
        spans = found if spans is None else spans.union(found)
        rows = known.where(F.struct("k1", "k2", "p0") == F.col("one")).join(
            core.where("near > 1"), ["gram", "b", "core"]).select(
            "k1", "k2", "gram", "at", "p0", "p1", "bytes", (F.col("open") & (F.col("times") == 1)).alias("open"))
    return spans


# ---- 2. and 4. ------------------------------------------------------------------------

def repeated_spans(rows: DataFrame, length: int = LENGTH) -> DataFrame:
    """``(k1, k2, spans)``: byte spans, unmerged, that repeated strings cover in
    each text of ``(k1, k2, text)``."""
    every = save(anchors(rows, length), "anchors")
    # Written first: with plain shuffles on both sides of the join a gram of many rows can be split.
    often = save(every.groupBy("gram").agg(F.count("*").alias("n")).where("n > 1").select("gram"), "grams-often")
    known = save(every.join(often, "gram"), "anchors-often")
    drop(every, often)
    by_context = save(known.groupBy("gram", "context").agg(
        F.count("*").alias("n"), F.min(F.struct("k1", "k2", "at", "low", "high")).alias("first")), "contexts")
    several = by_context.groupBy("gram").agg(F.count("*").alias("contexts"), F.min("n").alias("least"))
    several = save(several.where("contexts > 1 and least = 1").select("gram", "contexts"), "grams-open")

    whole = known.join(by_context.where("n > 1").select("gram", "context"), ["gram", "context"]).select(
        "k1", "k2", F.col("low").alias("start"), (F.col("high") + length).alias("stop"))

    open_ = by_context.join(several, "gram").select("gram", "contexts", "n", "first.*")
    per_row = open_.groupBy(F.col("k1").alias("o1"), F.col("k2").alias("o2")).agg(
        F.collect_list(F.struct("gram", "contexts", "n", "at", "low", "high")).alias("open"))
    texts = rows.join(per_row, (F.col("k1") == F.col("o1")) & (F.col("k2") == F.col("o2")))
    contexts = save(
        texts.select("k1", "k2", F.col("text").cast("binary").alias("data"), F.explode("open").alias("c"))
        .select("k1", "k2", "c.*", F.expr(f"substring(data, c.low + 1, c.high - c.low + {length})").alias("bytes")),
        "open-contexts")
    total = contexts.agg(F.sum(F.length("bytes"))).first()[0] or 0
    buckets = max(1, -(-total // BUCKET_BYTES))
    cool = contexts.where(F.col("contexts") <= HOT).withColumn(
        "bucket", F.pmod(F.xxhash64("gram"), F.lit(buckets)))
    spans = whole.union(_sorted_spans(cool, length))
    hot = contexts.where(F.col("contexts") > HOT)
    if not hot.isEmpty():
        spans = spans.union(_narrowed_spans(hot, length))
    out = save(spans.groupBy("k1", "k2").agg(F.collect_set(F.struct("start", "stop")).alias("spans")), "spans")
    drop(known, by_context, several, contexts)
    return out


def merged(spans) -> list[tuple[int, int]]:
    """Union of half-open spans as maximal runs."""
    out: list[list[int]] = []
    for start, stop in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], stop)
        else:
            out.append([start, stop])
    return [tuple(x) for x in out]


def cut(text: bytes, spans) -> tuple[bytes, list[tuple[int, int]]]:
    """What is left of a text, and the maximal runs that are gone."""
    runs, left, at = merged(spans), [], 0
    for start, stop in runs:
        left.append(text[at:start])
        at = stop
    left.append(text[at:])
    return b"".join(left), runs


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   length: int = LENGTH, with_rest: bool = False) -> DataFrame:
    """Per row the id, ``n_bytes``, ``n_removed``, ``n_spans`` and
    ``kept_sha256`` (and with ``with_rest`` the remaining bytes, ``rest``) after
    each byte is removed that a string of ``length`` bytes covers which starts
    at another place too, in this row or any other.

    Null and empty texts have no byte; a null id is an id like any other;
    repeated rows are each other's repeats; a text under ``length`` bytes stays
    whole; an empty table gives an empty result.  Only the two named columns are
    read.
    """
    k1, k2 = marks(F.col(id_col), F.col(text_col))
    rows = docs.select(F.col(id_col).alias("__id"), k1.alias("k1"), k2.alias("k2"), F.coalesce(
        F.col(text_col), F.lit("")).alias("text"))
    spans = repeated_spans(rows.select("k1", "k2", "text"), length).select(
        F.col("k1").alias("s1"), F.col("k2").alias("s2"), "spans")
    fields = [("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()),
              ("kept_sha256", pa.string())] + [("rest", pa.binary())] * with_rest
    kind = "n_bytes:bigint,n_removed:bigint,n_spans:bigint,kept_sha256:string" + ",rest:binary" * with_rest

    @arrow_udf(f"struct<{kind}>")
    def digest(texts: pa.Array, spans: pa.Array) -> pa.Array:
        out = []
        for t, s in zip(texts, spans, strict=True):
            text = t.as_py()
            rest, runs = cut(text, [(x["start"], x["stop"]) for x in s.as_py() or ()])
            out.append((len(text), len(text) - len(rest), len(runs), hashlib.sha256(rest).hexdigest(), rest))
        cols = list(zip(*out, strict=True)) or [[]] * 5
        return pa.StructArray.from_arrays([pa.array(c, k) for c, (_, k) in zip(cols, fields, strict=False)],
                                          names=[n for n, _ in fields])

    joined = rows.join(spans, (F.col("k1") == F.col("s1")) & (F.col("k2") == F.col("s2")), "left")
    return joined.select(F.col("__id").alias(id_col), digest(F.col("text").cast("binary"), "spans").alias("d")).select(
        id_col, "d.*")
