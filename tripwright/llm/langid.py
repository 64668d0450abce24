"""Language identification: multinomial naive Bayes over hashed character n-grams.

Training counts n-grams of labelled texts per language in Spark; the table of
log probabilities (languages x buckets, a fixed number of buckets) is broadcast.
A batch of texts is a sparse matrix of n-gram counts, and its product with the
table, in numpy, scores all of them.
"""

from __future__ import annotations

from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

ORDERS = (1, 2, 3)           # n-gram lengths
BUCKET_BITS = 15
BUCKETS = 1 << BUCKET_BITS
SMOOTHING = 0.5
ROWS_PER_LANGUAGE = 5_000    # bound on a language's labelled texts that the model sees
MAX_LANGUAGES = 256          # labels that are learned: the most frequent ones
STEP = 1 << 20               # code points hashed at once
ENTRIES = 1 << 16            # different n-grams of texts that are scored together, about
PRODUCT = 1 << 18            # numbers of a product held at once
UNKNOWN = "und"


@cache
def _letters() -> np.ndarray:
    """Which code points are letters."""
    return np.array([chr(i).isalpha() for i in range(0x110000)])


def grams(text: str):
    """Bucket numbers of the n-grams of the lower-cased text, a step at a time;
    whatever is not a letter counts as a space.  A text without a letter has
    none."""
    codes = np.frombuffer(text.lower().encode("utf-32-le", "replace"), np.uint32)
    letter = _letters()[codes]
    if not letter.any():
        return
    codes = np.concatenate([[32], np.where(letter, codes, 32), [32]]).astype(np.uint64)
    longest = max(ORDERS)
    for i in range(0, len(codes), STEP):
        part = codes[i:i + STEP + longest - 1]
        h = np.zeros(len(part), np.uint64)
        found = []
        for n in range(1, longest + 1):
            h = h[:len(part) - n + 1] * np.uint64(0x100000001B3) + part[n - 1:]
            if n in ORDERS:
                m = (h[:STEP] + np.uint64(n)) * np.uint64(0x9E3779B97F4A7C15)
                found.append((m >> np.uint64(64 - BUCKET_BITS)).astype(np.int64))
        yield np.concatenate(found)


def sample(named: DataFrame, bound: int = ROWS_PER_LANGUAGE) -> DataFrame:
    """Of different rows ``lang, id, text`` about nine tenths of ``bound`` for
    each language, and all of a smaller one: those whose hash is in the lowest
    part of the range.  How large a part follows from the languages' estimated
    numbers of different rows (a row per language, ``MAX_LANGUAGES`` at most: of
    more the most frequent ones), so rows are chosen where they are read and
    only the chosen texts are shuffled."""
    own = F.xxhash64("id", "text")
    sizes = (named.groupBy("lang").agg(F.approx_count_distinct(own, 0.02).alias("n"))
             .orderBy(F.desc("n"), "lang").limit(MAX_LANGUAGES)
             .select(F.col("lang").alias("l"), (F.lit(0.9 * bound) / F.col("n")).alias("share")))
    # The upper 53 bits of the hash as a number from 0 to 1.
    at = F.shiftrightunsigned(own, 11).cast("double") / float(1 << 53)
    return (named.join(F.broadcast(sizes), F.col("lang") == F.col("l"))      # a row per language
            .where((at < F.col("share")) | (F.col("share") >= 0.9))
            .select("lang", "id", "text").dropDuplicates(["lang", "id", "text"]))


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
          bound: int = ROWS_PER_LANGUAGE) -> tuple[list[str], np.ndarray]:
    """Languages and log probabilities, from the :func:`sample` of the rows
    without a null.  The table has a fixed number of buckets per language."""
    named = docs.select(F.col(lang_col).alias("lang"), F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    chosen = sample(named.where("lang is not null and id is not null and text is not null"), bound)

    def count(batches):
        total: dict[str, np.ndarray] = {}
        for b in batches:
            for lang, text in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                have = total.setdefault(lang, np.zeros(BUCKETS, np.int64))
                for g in grams(text.as_py()):
                    have += np.bincount(g, minlength=BUCKETS)
        for lang, have in total.items():
            at = np.nonzero(have)[0]
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(at)), pa.array(at), pa.array(have[at])], ["lang", "bucket", "n"])

    got = (chosen.select("lang", "text").mapInArrow(count, "lang string, bucket long, n long")
           .groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toArrow())     # MAX_LANGUAGES * BUCKETS rows at most
    langs, row = np.unique(got.column("lang").to_numpy(), return_inverse=True)
    table = np.full((len(langs), BUCKETS), SMOOTHING)
    np.add.at(table, (row, got.column("bucket").to_numpy()), got.column("n").to_numpy())
    return langs.tolist(), np.log(table / table.sum(axis=1, keepdims=True)).astype(np.float32)


def sparse_counts(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """The different buckets of a text's n-grams and how often each occurs."""
    total = None
    for g in grams(text or ""):
        n = np.bincount(g, minlength=BUCKETS)
        total = n if total is None else total + n
    if total is None:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    at = np.nonzero(total)[0]
    return at, total[at]


def batch_scores(texts, table: np.ndarray):
    """``(row of the best language, its posterior with equal priors)`` of each
    text, -1 and 0 for one that is null or has no letter.

    ``table`` has a row per bucket.  The texts' counts make a sparse matrix, text
    by bucket, that is multiplied with the table once it holds enough entries;
    a slice of the product is at most ``PRODUCT`` numbers, however long the texts
    and however many the languages.
    """
    languages = table.shape[1]
    step = max(1, PRODUCT // max(1, languages))
    at, n = (np.empty(ENTRIES + BUCKETS, np.int32) for _ in range(2))      # the matrix: column and value of its entries,
    ends: list[int] = []                                                   # by text
    out = []

    def flush():
        sizes = np.diff([0, *ends])
        total = np.zeros((len(sizes), languages))
        owner = np.repeat(np.arange(len(sizes)), sizes)
        for i in range(0, len(owner), step):
            mine = owner[i:i + step]
            first = np.concatenate([[0], np.nonzero(np.diff(mine))[0] + 1])
            product = table[at[i:i + len(mine)]] * n[i:i + len(mine), None].astype(np.float64)
            total[mine[first]] += np.add.reduceat(product, first, axis=0)
        best = total.argmax(axis=1) if languages else None
        for k, size in enumerate(sizes.tolist()):
            if not size or not languages:
                out.append((-1, 0.0))
            else:
                out.append((int(best[k]), float(1 / np.exp(total[k] - total[k, best[k]]).sum())))
        ends.clear()

    for text in texts:
        b, c = sparse_counts(text)
        have = ends[-1] if ends else 0
        at[have:have + len(b)], n[have:have + len(b)] = b, np.minimum(c, np.iinfo(np.int32).max)
        ends.append(have + len(b))
        if ends[-1] > ENTRIES:
            flush()
    if ends:
        flush()
    return out


def predict(docs: DataFrame, model: tuple[list[str], np.ndarray], text_col: str = "text"):
    """Struct column ``(lang_pred, score)`` of a text column; only the text is
    an input."""
    spread = docs.sparkSession.sparkContext.broadcast((model[0], np.ascontiguousarray(model[1].T)))
    kind = pa.struct([("lang_pred", pa.string()), ("score", pa.float64())])

    @arrow_udf("struct<lang_pred:string,score:double>")
    def run(texts: pa.Array) -> pa.Array:
        langs, table = spread.value
        got = batch_scores((t.as_py() for t in texts), table)
        return pa.StructArray.from_arrays(
            [pa.array([langs[i] if i >= 0 else UNKNOWN for i, _ in got], pa.string()),
             pa.array([s for _, s in got], pa.float64())], fields=list(kind))
    return run(F.col(text_col))


def held_out(id_col: str = "doc_id"):
    """True for the fourth of all ids that is never learned from."""
    return F.coalesce(F.pmod(F.crc32(F.col(id_col).cast("string")), F.lit(4)) == 2, F.lit(False))


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             lang_col: str = "lang") -> DataFrame:
    """Id, ``held_out``, ``lang_pred`` and ``score`` of every row, with a model
    learned from rows that are not held out.

    Null texts and texts without a letter are ``und`` with score 0, and so is
    every text if nothing could be learned; null languages and null ids teach
    nothing; a null id is not held out; of tied languages the first by name
    wins; repeated rows teach once and are all scored; of more than
    ``MAX_LANGUAGES`` labels the most frequent are learned and the others never
    predicted; an empty table gives an empty result.  Columns other than those named are not read.
    """
    model = train(docs.where(~held_out(id_col)), id_col, text_col, lang_col)
    rows = docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("__text"))
    rows = rows.select("__id", predict(rows, model, "__text").alias("p"))
    return rows.select(F.col("__id").alias(id_col), held_out("__id").alias("held_out"),
                       "p.lang_pred", "p.score")
