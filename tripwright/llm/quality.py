"""Quality rules: an ordered decision list learned by sequential covering.

Statistics of whole texts are one Arrow-batched column.  From labelled rows the
learner grows conjunctions of thresholds for either class by information gain,
prunes them on held-back rows, takes the surer one if it is precise there, removes
what it covers, and goes on.  Rules that keep and rules that reject follow each
other, and the first that holds decides: a plain ordered Spark CASE expression.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

TRAINING_ROWS = 20_000       # bound on the labelled rows that the learner sees
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
MAX_RULES = 12
MAX_CONDITIONS = 4
MIN_COVER = 8                # held-out rows behind a rule
MIN_PRECISION = 0.9          # of a rule, on held-out rows
TRIES = 3                    # imprecise rules of a class before it has none

SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\v\f\r"

STATS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
         "n_upper", "n_marks", "n_distinct_words"]


def text_stats(text: str | None) -> tuple[int, ...]:
    """The statistics named in ``STATS`` of one whole text (null: all zero)."""
    text = text or ""
    words = text.encode().split()
    blank = sum(map(text.count, SPACES))
    lines = Counter(line for line in text.split("\n") if line.strip(SPACES))
    windows = list(zip(words, words[1:], words[2:], strict=False))
    repeated = 0
    if len(set(windows)) < len(windows):
        counts = Counter(windows)
        end = 0                       # words before it are counted
        for i, w in enumerate(windows):
            if counts[w] > 1:
                repeated += i + 3 - max(end, i)
                end = i + 3
    return (len(words), len(text) - blank, sum(map(text.count, SYMBOLS)),
            sum(lines.values()) - len(lines), repeated,
            sum(map(str.isupper, text)), sum(map(text.count, "!?")), len(set(words)))


def stats(text) -> Column:
    """Struct column of ``STATS`` (long) of a text column."""
    kind = pa.struct([(n, pa.int64()) for n in STATS])

    @arrow_udf("struct<" + ",".join(f"{n}:bigint" for n in STATS) + ">")
    def compute(texts: pa.Array) -> pa.Array:
        rows = [text_stats(t.as_py()) for t in texts]
        cols = list(zip(*rows, strict=True)) or [[]] * len(STATS)
        return pa.StructArray.from_arrays([pa.array(c, pa.int64()) for c in cols], fields=list(kind))
    return compute(text)


# Learner features as (name, numerator, denominator), all from STATS.
RATIOS = [
    ("n_words", "n_words", None),
    ("chars_per_word", "word_chars", "n_words"),
    ("symbols_per_word", "n_symbols", "n_words"),
    ("marks_per_word", "n_marks", "n_words"),
    ("upper_share", "n_upper", "word_chars"),
    ("repeat_share", "n_repeat_words", "n_words"),
    ("distinct_share", "n_distinct_words", "n_words"),
    ("dup_lines", "n_dup_lines", None),
]


def feature(stat: Column, name: str) -> Column:
    """A learner feature as a Spark expression over the statistics."""
    top, bottom = {n: (a, b) for n, a, b in RATIOS}[name]
    value = stat[top].cast("double")
    return value if bottom is None else value / F.greatest(stat[bottom], F.lit(1))


def features(rows: np.ndarray) -> np.ndarray:
    """The same features of a matrix with a column for each of ``STATS``."""
    at = {n: rows[:, i].astype(np.float64) for i, n in enumerate(STATS)}
    return np.stack([at[a] if b is None else at[a] / np.maximum(at[b], 1) for _, a, b in RATIOS], axis=1)


# ---- learner --------------------------------------------------------------------

@dataclass(frozen=True)
class Condition:
    name: str
    above: bool          # feature > threshold, else feature <= threshold
    threshold: float


@dataclass(frozen=True)
class Rule:
    conditions: tuple[Condition, ...]
    keep: bool
    precision: float     # on held-out rows
    cover: int


def _holds(x: np.ndarray, c: Condition) -> np.ndarray:
    col = x[:, [n for n, _, _ in RATIOS].index(c.name)]
    return col > c.threshold if c.above else col <= c.threshold


def _covered(x: np.ndarray, conditions) -> np.ndarray:
    hit = np.ones(len(x), bool)
    for c in conditions:
        hit &= _holds(x, c)
    return hit


def _best_condition(x: np.ndarray, y: np.ndarray) -> Condition | None:
    """The threshold with the largest FOIL gain for the class ``y``."""
    p0, n0 = y.sum(), len(y) - y.sum()
    base, best = np.log2(p0 / (p0 + n0)), (1e-9, None)
    for j, (name, _, _) in enumerate(RATIOS):
        order = np.argsort(x[:, j], kind="stable")
        v, pos = x[order, j], np.cumsum(y[order])
        cuts = np.nonzero(v[1:] > v[:-1])[0]
        if not len(cuts):
            continue
        for above in (True, False):
            p = pos[-1] - pos[cuts] if above else pos[cuts]
            m = len(v) - 1 - cuts if above else cuts + 1
            with np.errstate(divide="ignore"):
                gain = np.where(p > 0, p * (np.log2(np.maximum(p, 1e-9) / m) - base), 0)
            k = int(np.argmax(gain))
            if gain[k] > best[0]:
                best = (gain[k], Condition(name, above, float((v[cuts[k]] + v[cuts[k] + 1]) / 2)))
    return best[1]


def _grow(x: np.ndarray, y: np.ndarray) -> list[Condition]:
    out, hit = [], np.ones(len(x), bool)
    while len(out) < MAX_CONDITIONS and 0 < y[hit].sum() < hit.sum():
        c = _best_condition(x[hit], y[hit])
        if c is None:
            break
        out.append(c)
        hit &= _holds(x, c)
    return out


def _prune(x: np.ndarray, y: np.ndarray, rule: list[Condition]) -> list[Condition]:
    """Drop conditions, whichever it is best to lose, while that doesn't lower
    (p - n) / (p + n)."""
    def worth(conditions):
        hit = _covered(x, conditions)
        return (2 * y[hit].sum() - hit.sum()) / max(1, hit.sum())
    while len(rule) > 1:
        shorter = max(([c for c in rule if c is not gone] for gone in reversed(rule)), key=worth)
        if worth(shorter) < worth(rule):
            break
        rule = shorter
    return rule


def _candidate(x: np.ndarray, y: np.ndarray, left: np.ndarray, held: np.ndarray):
    """The first precise rule for the rows with ``y`` among those ``left``, with
    its right and covered held-out rows; None if ``TRIES`` were not precise.
    What an imprecise one covers is set aside for the next."""
    tried = np.zeros(len(x), bool)
    for _ in range(TRIES):
        grow, judge = left & ~held & ~tried, left & held
        if not y[grow].any() or not y[judge].any():
            return None
        rule = _grow(x[grow], y[grow])
        if not rule:
            return None
        rule = _prune(x[judge], y[judge], rule)
        hit = judge & _covered(x, rule)
        cover, right = int(hit.sum()), int(y[hit].sum())
        if cover >= MIN_COVER and right >= MIN_PRECISION * cover:
            return rule, right, cover
        tried |= _covered(x, rule)
    return None


def learn(rows: np.ndarray, good: np.ndarray, held: np.ndarray) -> list[Rule]:
    """The decision list: rules for either class in the order in which they
    decide, and last a default without conditions.  ``rows`` has the ``STATS``;
    ``held`` marks the rows used for pruning and for judging rules only.

    Of the best rule of each class the one that is surer on held-out rows comes
    first; what it covers is decided, and the rest is learned from.  The default
    is the class of most rows that are left, but to reject it must be as precise
    as a rule.  Equal rules of both classes: the rejecting one.
    """
    x, good = features(rows), good.astype(bool)
    left, rules = np.ones(len(x), bool), []
    while len(rules) < MAX_RULES:
        found = [(c, keep) for keep in (False, True) if (c := _candidate(x, good == keep, left, held))]
        if not found:
            break
        (rule, right, cover), keep = max(found, key=lambda f: ((f[0][1] + 1) / (f[0][2] + 2), not f[1]))
        rules.append(Rule(tuple(rule), keep, right / cover, cover))
        left &= ~_covered(x, rule)
    rest = left & held
    cover, bad = int(rest.sum()), int((rest & ~good).sum())
    reject = cover >= MIN_COVER and bad >= MIN_PRECISION * cover
    if rules:
        rules.append(Rule((), not reject, (bad if reject else cover - bad) / max(1, cover), cover))
    return rules


def verdict(stat: Column, rules: list[Rule]) -> Column:
    """The decision list as one ordered CASE expression: the first rule that
    holds decides; an empty list keeps all."""
    out = None
    for rule in rules:
        if not rule.conditions:
            return F.lit(rule.keep) if out is None else out.otherwise(F.lit(rule.keep))
        hit = F.lit(True)
        for c in rule.conditions:
            v = feature(stat, c.name)
            hit &= (v > c.threshold) if c.above else (v <= c.threshold)
        out = F.when(hit, F.lit(rule.keep)) if out is None else out.when(hit, F.lit(rule.keep))
    return F.lit(True) if out is None else out.otherwise(F.lit(True))


def base_failed(stat: Column) -> Column:
    return (stat["n_words"] < MIN_WORDS) | (
        100 * stat["n_repeat_words"] > MAX_REPEAT_PERCENT * stat["n_words"])


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "quality", bound: int = TRAINING_ROWS) -> list[Rule]:
    """Learn from at most ``bound`` labelled rows, those first in the order of
    a hash of their id.  Null ids and labels teach nothing; of several labels
    of one id the smallest counts."""
    chosen = (labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull())
              .groupBy(F.col(id_col).cast("long").alias("__id"))
              .agg((F.min(label_col) > 0).alias("good"))
              .orderBy(F.xxhash64("__id"), "__id").limit(bound))
    stat = stats(F.col(text_col)).alias("s")
    rows = (docs.select(F.col(id_col).alias("__doc"), F.col(text_col))
            .join(F.broadcast(chosen), F.col("__doc") == F.col("__id"))    # at most `bound` rows
            .select("__id", "good", stat))
    rows = rows.select("__id", "good", "s.*", (F.pmod(F.xxhash64("__id", F.lit(7)), F.lit(3)) == 0).alias("held"))
    got = rows.orderBy(F.xxhash64("__id"), "__id", *STATS).limit(bound).toArrow()
    matrix = np.stack([got.column(n).to_numpy() for n in STATS], axis=1).reshape(-1, len(STATS))
    return learn(matrix, got.column("good").to_numpy(zero_copy_only=False),
                 got.column("held").to_numpy(zero_copy_only=False))


def judge(docs: DataFrame, rules: list[Rule], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Id, statistics, ``base_failed`` and ``kept`` of every row.

    A null or empty text has no word and fails the base rule; null ids and
    repeated rows are judged like any other; an empty table gives an empty
    result.  Only the two named columns are read.
    """
    s = F.col("__s")
    rows = docs.select(F.col(id_col).alias("__id"), stats(F.col(text_col)).alias("__s"))
    failed = base_failed(s)
    return rows.select(F.col("__id").alias(id_col), *[s[n].alias(n) for n in STATS[:5]],
                       failed.alias("base_failed"),
                       F.when(failed, F.lit(False)).otherwise(verdict(s, rules)).alias("kept"),
                       *[s[n].alias(n) for n in STATS[5:]])


def keep_good(docs: DataFrame, rules: list[Rule], text_col: str = "text") -> DataFrame:
    """The rows that the rules keep, with their columns."""
    s = F.col("__s")
    return (docs.withColumn("__s", stats(F.col(text_col)))
            .where(~base_failed(s) & verdict(s, rules)).drop("__s"))
