"""Benchmark decontamination by spaced-seed hashing, in DataFrame operations.

Texts and items become arrays of token hashes.  Each mask hashes the tokens at
its positions and ignores those between, so a hit survives substitutions at the
ignored places.  Equal seeds of texts and items are joined; around each hit the
item is laid over the text at that offset, and a window that agrees in all but
a few tokens confirms the overlap.  The masks are lossless: every window of
``WINDOW`` tokens with at most ``SUBSTITUTIONS`` of them substituted has a hit
(a test checks this for all substitution patterns).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import drop, marks, save

WINDOW = 12
SUBSTITUTIONS = 2
# Positions of each spaced seed.
MASKS = [
    (0, 1, 2, 4, 5),
    (0, 1, 3, 6, 7),
]
MAX_BROADCAST_ROWS = 1_000_000     # hashes of rows with a hit (16 bytes each); more are joined by shuffle
MAX_BROADCAST_SEEDS = 1_000_000    # seed rows of the items (32 bytes each); more are joined by shuffle


def token_hashes(text: Column) -> Column:
    """Hashes of the lower-cased runs of letters and digits of a text."""
    words = F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+", -1), lambda w: w != "")
    return F.transform(words, lambda w: F.xxhash64(w))


def _seeds(tokens: Column) -> Column:
    """One array with the seeds of all masks one mask after the other."""
    def of(number, mask):
        places = F.sequence(F.lit(0), F.size(tokens) - (mask[-1] + 1))
        return F.when(F.size(tokens) > mask[-1], F.transform(places, lambda i: F.xxhash64(
            F.lit(number), *[F.get(tokens, i + o) for o in mask]))).otherwise(
            F.array().cast("array<bigint>"))
    return F.concat(*[of(i, m) for i, m in enumerate(MASKS)])


def _place(pos: Column, n: Column) -> Column:
    """Token position of a seed in that array, for a text of ``n`` tokens."""
    out, before = None, F.lit(0)
    for mask in MASKS:
        size = F.greatest(n - mask[-1], F.lit(0))
        here = pos < before + size
        out = F.when(here, pos - before) if out is None else out.when(here, pos - before)
        before = before + size
    return out


def hits(docs: DataFrame, items: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Distinct ``(k1, k2, item_id, shift)``: an item laid ``shift`` tokens into
    a row's text has a seed in common with it there."""
    k1, k2 = marks(F.col(id_col), F.col(text_col))
    rows = docs.select(k1.alias("k1"), k2.alias("k2"), token_hashes(F.col(text_col)).alias("t"))
    theirs = rows.select("k1", "k2", F.size("t").alias("n"), F.posexplode_outer(_seeds(F.col("t"))).alias("pos", "seed"))
    ours = items.select("item_id", F.size("t").alias("m"), F.posexplode_outer(_seeds(F.col("t"))).alias("at", "seed"))
    ours = ours.select("item_id", F.col("seed").alias("own"), _place(F.col("at"), F.col("m")).alias("at"))
    if ours.limit(MAX_BROADCAST_SEEDS + 1).count() <= MAX_BROADCAST_SEEDS:
        ours = F.broadcast(ours)
    return theirs.join(ours, theirs.seed == ours.own).select(
        "k1", "k2", "item_id", (_place(F.col("pos"), F.col("n")) - F.col("at")).alias("shift")).distinct()


def _bound(value: Column, body) -> Column:
    """``body`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), body), 0)


def _judged(tokens: Column, item: Column, shifts: Column, window: int, substitutions: int) -> Column:
    """Of an array of shifts those with a confirmed window, ascending, with the
    first window's start and the last one's end as item positions and the number
    of equal tokens between.  Nothing is kept of a shift but these numbers.

    Between the places before and after a run of ``substitutions`` differing
    tokens all windows are good ones; so the differing places tell them."""
    m = F.size(item)

    def laid(shift):
        bad = F.filter(F.sequence(F.lit(0), m - 1), lambda j: ~F.coalesce(
            F.get(tokens, j + shift) == F.get(item, j), F.lit(False)))
        return _bound(bad, lambda bad: _bound(
            F.concat(F.array(F.lit(-1)), bad, F.array_repeat(m, substitutions + 1)), lambda edges: _bound(
                F.filter(F.sequence(F.lit(0), F.size(bad)), lambda i: F.get(
                    edges, i + substitutions + 1) - F.get(edges, i) > window), lambda good: F.when(
                        F.size(good) > 0, _bound(F.struct(
                            (F.get(edges, F.get(good, 0)) + 1).alias("first"),
                            F.get(edges, F.element_at(good, -1) + substitutions + 1).alias("stop")), lambda x: F.struct(
                                shift.alias("shift"), x["first"].alias("first"), x["stop"].alias("stop"),
                                (x["stop"] - x["first"] - F.size(F.filter(bad, lambda j: (j >= x["first"]) & (
                                    j < x["stop"])))).alias("n_same")))))))

    return F.filter(F.transform(F.array_sort(shifts), laid), lambda x: x.isNotNull())


def _small(keys: DataFrame) -> DataFrame:
    """Row hashes, broadcast if they are few: the texts are then joined to them
    where they are read, and not shuffled."""
    return F.broadcast(keys) if keys.limit(MAX_BROADCAST_ROWS + 1).count() <= MAX_BROADCAST_ROWS else keys


def overlaps(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             item_col: str = "item_id", item_text: str = "text", window: int = WINDOW,
             substitutions: int = SUBSTITUTIONS) -> DataFrame:
    """Confirmed overlaps: k1, k2 (hashes of the row), the id, item_id,
    doc_token and item_token (where the overlap begins), n_tokens, n_same.

    An overlap is a stretch of an item laid over a text that begins and ends
    with ``window`` tokens of which at most ``substitutions`` differ.  Relative
    places of a row and an item that follow each other by less than ``window``
    tokens are one: the one with most equal tokens, of such the first.  Tokens
    are lower-cased runs of letters and digits.  Null and empty texts, and items
    of fewer than ``window`` tokens, match nothing; a null id is an id like any
    other; rows equal in id and text are one row and give one result; an empty
    table on either side gives an empty result.  Only the named columns are read.
    """
    rows = docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("__text"))
    items = save(benchmark.select(F.col(item_col).alias("item_id"), token_hashes(
        F.col(item_text)).alias("item")).where(F.size("item") >= window), "items")
    found = save(hits(rows, items.withColumnRenamed("item", "t"), "__id", "__text"), "seed-hits")
    near = save(found.select(F.col("k1").alias("d1"), F.col("k2").alias("d2")).distinct(), "hit-rows")
    k1, k2 = marks(F.col("__id"), F.col("__text"))
    texts = rows.withColumns({"k1": k1, "k2": k2}).join(
        _small(near), (F.col("k1") == F.col("d1")) & (F.col("k2") == F.col("d2")), "left_semi")
    texts = texts.dropDuplicates(["k1", "k2"]).select("k1", "k2", "__id", token_hashes(F.col("__text")).alias("tokens"))
    laid = (found.groupBy("k1", "k2", "item_id").agg(F.collect_set("shift").alias("shifts"))     # of one text
            .join(texts, ["k1", "k2"]))
    laid = laid.join(items.withColumnRenamed("item_id", "__item"), F.col("item_id").eqNullSafe(F.col("__item")))
    # explode_outer: a plain explode would test the whole expression in a pushed filter as well.
    x = laid.select("k1", "k2", "__id", "item_id", F.explode_outer(_judged(
        F.col("tokens"), F.col("item"), F.col("shifts"), window, substitutions)).alias("x")).where(F.col("x").isNotNull())
    order = Window.partitionBy("k1", "k2", "item_id").orderBy("x.shift")
    apart = F.coalesce(F.col("x.shift") - F.lag("x.shift").over(order) >= window, F.lit(True)).cast("int")
    x = x.withColumn("apart", apart).withColumn("place", F.sum("apart").over(order))
    best = x.groupBy("k1", "k2", "item_id", "place").agg(
        F.first("__id").alias(id_col),
        F.max(F.struct("x.n_same", (-F.col("x.shift")).alias("back"), "x.first", "x.stop")).alias("x"))
    out = save(best.select(
        "k1", "k2", id_col, "item_id", (F.col("x.first") - F.col("x.back")).alias("doc_token"),
        F.col("x.first").alias("item_token"), (F.col("x.stop") - F.col("x.first")).alias("n_tokens"), "x.n_same"), "overlaps")
    drop(items, found, near)
    return out


def clean(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows without a confirmed overlap, with their columns."""
    found = overlaps(docs, benchmark, id_col, text_col)
    dirty = save(found.select(F.col("k1").alias("d1"), F.col("k2").alias("d2")).distinct(), "contaminated")
    drop(found)
    k1, k2 = marks(F.col(id_col), F.col(text_col))
    rows = docs.withColumns({"__k1": k1, "__k2": k2})
    return rows.join(_small(dirty).select(F.col("d1").alias("__d1"), F.col("d2").alias("__d2")),
                     (F.col("__k1") == F.col("__d1")) & (F.col("__k2") == F.col("__d2")), "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])


# Every such window has at least 4 equal tokens in a row, so 4-grams find all.
OVERLAPS_SQL = f"""
WITH d AS (SELECT doc_id, list_filter(string_split_regex(lower(text), '[^\\p{{L}}\\p{{N}}]+'),
                                      lambda x: x <> '') AS t FROM documents),
b AS (SELECT item_id, list_filter(string_split_regex(lower(text), '[^\\p{{L}}\\p{{N}}]+'),
                                  lambda x: x <> '') AS u FROM benchmark),
dg AS (SELECT doc_id, i, t[i + 1:i + 4] AS g FROM (SELECT *, unnest(range(len(t) - 3)) AS i FROM d WHERE len(t) > 3)),
bg AS (SELECT item_id, j, u[j + 1:j + 4] AS g FROM (SELECT *, unnest(range(len(u) - 3)) AS j FROM b WHERE len(u) >= {WINDOW})),
laid AS (SELECT DISTINCT doc_id, item_id, i - j AS shift FROM dg JOIN bg USING (g)),
agree AS (
  SELECT doc_id, item_id, shift, list_transform(range(len(u)), lambda k:
    CASE WHEN k + shift >= 0 AND k + shift < len(t) AND t[k + shift + 1] = u[k + 1] THEN 1 ELSE 0 END) AS same
  FROM laid JOIN d USING (doc_id) JOIN b USING (item_id)),
judged AS (
  SELECT *, list_filter(range(len(same) - {WINDOW - 1}),
                        lambda s: list_sum(same[s + 1:s + {WINDOW}]) >= {WINDOW - SUBSTITUTIONS}) AS good FROM agree),
confirmed AS (
  SELECT doc_id, item_id, shift, list_min(good) AS a, list_max(good) + {WINDOW} AS b,
         list_sum(same[list_min(good) + 1:list_max(good) + {WINDOW}]) AS n_same
  FROM judged WHERE len(good) > 0),
begun AS (
  SELECT *, coalesce(shift - lag(shift) OVER (PARTITION BY doc_id, item_id ORDER BY shift) >= {WINDOW}, true) AS new
  FROM confirmed),
placed AS (
  SELECT *, sum(new::INT) OVER (PARTITION BY doc_id, item_id ORDER BY shift) AS place FROM begun),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY doc_id, item_id, place ORDER BY n_same DESC, shift) AS nth FROM placed)
SELECT doc_id, item_id, (a + shift)::INT AS doc_token, a::INT AS item_token, (b - a)::INT AS n_tokens, n_same::INT AS n_same
FROM ranked WHERE nth = 1
"""
