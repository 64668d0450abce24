"""Personal data: fixed shapes, and identifiers that their surroundings give away.

Emails, addresses, card and phone numbers of exact shape are found in whole texts
(the base).  They are the seeds of a bootstrap: the words around a seed are
lexical patterns, and looser strings (a phone number without a plus sign, a card
number with a wrong digit, ``name [at] host``, an IPv6 address) are instances that
the same patterns may surround.  Spark scores the graph of patterns and instances
in rounds: a pattern is worth the share of its different instances that are of a
kind, an instance the best accepted pattern around it, and what was learned counts
in the next round.  Loose strings within accepted patterns become spans.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import drop, save

KINDS = ("email", "ip", "card", "phone")
EMAIL, IP, CARD, PHONE = range(len(KINDS))

ROUNDS = 3
ONE = 1000                 # scores are counted in thousandths: sums don't depend on their order
MIN_SCORE = 800            # of an accepted pattern
MIN_SUPPORT = 5 * ONE      # summed score of its instances
PRIOR = 1                  # instances of no kind that every pattern is given
CUE = 64                   # a longer word is no cue, and cues begin within twice that many code points

# ---- base shapes --------------------------------------------------------------------
# Each pattern below starts at a character that its own repeats can't contain, or
# matches wherever it starts: a scan is linear in the text.

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
HOST = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
DOTTED = re.compile(r"[0-9]++(?:\.[0-9]++)*+")
DIGITS = re.compile(r"[0-9]++(?:[ -][0-9]++)*+")
PLUS = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
NO_DIGIT = re.compile(r"[^0-9]+")


def emails(text: str) -> list[tuple[int, int]]:
    """A host after each @, and before it all local characters up to the
    previous email."""
    out, last = [], 0
    for m in HOST.finditer(text):
        start = m.start()
        while start > last and text[start - 1] in LOCAL:
            start -= 1
        if start < m.start():
            out.append((start, m.end()))
            last = m.end()
    return out


def addresses(text: str) -> list[tuple[int, int]]:
    """Of each chain of numbers joined by dots, four by four from the left."""
    out = []
    for m in DOTTED.finditer(text):
        if m.group().count(".") < 3:
            continue
        groups, at = m.group().split("."), m.start()
        for i in range(0, len(groups) - 3, 4):
            four = groups[i:i + 4]
            end = at + sum(map(len, four)) + 3
            if all(len(x.lstrip("0")) <= 3 and int(x[-4:]) <= 255 for x in four):
                out.append((at, end))
            at = end + 1
    return out


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(map(int, reversed(digits))):
        total += d if i % 2 == 0 else 2 * d - 9 * (d > 4)
    return total % 10 == 0


def cards(text: str) -> list[tuple[int, int]]:
    out = []
    for m in DIGITS.finditer(text):
        if m.end() - m.start() >= 16:
            digits = NO_DIGIT.sub("", m.group())
            if 16 <= len(digits) <= 19 and luhn(digits):
                out.append(m.span())
    return out


def phones(text: str) -> list[tuple[int, int]]:
    return [m.span() for m in PLUS.finditer(text) if 8 <= len(NO_DIGIT.sub("", m.group())) <= 15]


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """``(kind, start, end)`` in the order of kind and start."""
    found = (emails(text) if "@" in text else [], addresses(text), cards(text),
             phones(text) if "+" in text else [])
    return [(k, s, e) for k, spans in enumerate(found) for s, e in spans]


# ---- loose strings and their surroundings ----------------------------------------------

NUMBERS = re.compile(r"[0-9]++(?:[ ./()-]{1,2}+[0-9]++)*+")
COLONS = re.compile(r"(?<![0-9A-Za-z:])[0-9A-Fa-f]{0,4}(?::[0-9A-Fa-f]{0,4}){3,7}(?![0-9A-Za-z:])")
AT = re.compile(r"(?: ?[\[(]at[\])] ?| at (?=[A-Za-z0-9-]{1,63} dot )|@)(?=[A-Za-z0-9])")
REST = re.compile(r"[A-Za-z0-9-]{1,63}(?:(?: ?[\[(]dot[\])] ?| dot |\.)[A-Za-z0-9-]{1,63}){0,8}")
EDGES = ".,;:!?()[]{}<>\"'`|*#=&%$/\\-_"


def loose(text: str) -> list[tuple[int, int, int]]:
    """``(mask of possible kinds, start, end)`` of loose strings, none overlapping."""
    out = []
    for m in NUMBERS.finditer(text):
        n = len(NO_DIGIT.sub("", m.group())) if m.end() - m.start() >= 7 else 0
        mask = (7 <= n <= 15) << PHONE | (12 <= n <= 19) << CARD
        if mask:
            out.append((mask, *m.span()))
    if ":" in text:
        out += [(1 << IP, *m.span()) for m in COLONS.finditer(text)]
    for m in AT.finditer(text):
        start = m.start()
        while start > max(0, m.start() - CUE) and text[start - 1] in LOCAL:
            start -= 1
        if start < m.start():
            out.append((1 << EMAIL, start, REST.match(text, m.end()).end()))
    out.sort(key=lambda x: (x[1], -x[2]))
    last, kept = 0, []
    for x in out:
        if x[1] >= last:
            kept.append(x)
            last = x[2]
    return kept


def word(token: str) -> str:
    w = token.strip(EDGES).lower()
    return w if len(w) <= CUE and w.isalpha() else ""


def cues(text: str, start: int, end: int) -> list[str]:
    """The lexical patterns around a span: the word before, the two before, the
    word after, the words on both sides."""
    at = max(0, start - 2 * CUE)
    tokens = text[at:start].split()
    if at and tokens and not text[at - 1].isspace():
        tokens = tokens[1:]                      # cut by the window
    left = [word(t) for t in tokens[-2:]]
    tokens = text[end:end + 2 * CUE].split(maxsplit=2)
    while tokens and not tokens[0].strip(EDGES):     # punctuation that closes the span
        tokens = tokens[1:]
    right = word(tokens[0]) if tokens else ""
    out = []
    if left and left[-1]:
        out.append(f"{left[-1]} _")
        if len(left) > 1 and left[0]:
            out.append(f"{left[0]} {left[1]} _")
        if right:
            out.append(f"{left[-1]} _ {right}")
    if right:
        out.append(f"_ {right}")
    return out


def value(text: str, kind_mask: int) -> str:
    """What makes two strings one instance: digits of numbers, else the letters'
    lower case; long ones by their digest."""
    v = NO_DIGIT.sub("", text) if kind_mask & (1 << CARD | 1 << PHONE) else text.lower()
    return v if len(v) <= 128 else hashlib.sha256(v.encode()).hexdigest()


def slots(text: str, base: list[tuple[int, int, int]]) -> list[tuple]:
    """``(kind or -1, mask, start, end, value, patterns)`` of the base spans and
    of the loose strings between them."""
    out = [(k, 1 << k, s, e, value(text[s:e], 1 << k), cues(text, s, e)) for k, s, e in base]
    at = 0
    for s, e in [*sorted((s, e) for _, s, e in base), (len(text), len(text))]:
        if s > at:
            for mask, a, b in loose(text[at:s]):
                a, b = a + at, b + at
                out.append((-1, mask, a, b, value(text[a:b], mask), cues(text, a, b)))
        at = max(at, e)
    return out


SPAN = "struct<kind:int,start:int,end:int>"
SLOT = "struct<kind:int,mask:int,start:int,end:int,value:string,patterns:array<string>>"


def scanned(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``row, id, base, slots`` of each document, in one pass over the texts."""
    span = pa.struct([(n, pa.int32()) for n in ("kind", "start", "end")])
    slot = pa.struct([*((n, pa.int32()) for n in ("kind", "mask", "start", "end")),
                      ("value", pa.string()), ("patterns", pa.list_(pa.string()))])

    def run(batches):
        for b in batches:
            bases, found = [], []
            for text in b.column("text"):
                t = text.as_py() or ""
                base = base_spans(t)
                bases.append([dict(zip(("kind", "start", "end"), x, strict=True)) for x in base])
                found.append([dict(zip(("kind", "mask", "start", "end", "value", "patterns"), x, strict=True))
                              for x in slots(t, base)])
            yield pa.RecordBatch.from_arrays(
                [b.column("row"), b.column("id"), pa.array(bases, pa.list_(span)), pa.array(found, pa.list_(slot))],
                ["row", "id", "base", "slots"])

    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"),
                       F.col(text_col).alias("text"))
    return rows.mapInArrow(run, f"row long, id {dict(rows.dtypes)['id']}, base array<{SPAN}>, slots array<{SLOT}>")


# ---- pattern-instance graph ---------------------------------------------------------------

def edges_of(found: DataFrame) -> DataFrame:
    """Distinct ``(pattern, value, kind, mask)``: however often a text is copied,
    an instance counts once for a pattern."""
    s = found.select(F.explode("slots").alias("s"))
    return s.select(F.explode("s.patterns").alias("pattern"), "s.value", "s.kind", "s.mask").distinct()


def _scores(kind: Column) -> list[Column]:
    return [F.when(kind == k, F.lit(ONE)).otherwise(0).cast("long").alias(f"s{k}") for k in range(len(KINDS))]


def _possible(kind: Column) -> Column:
    """Whether the row's mask holds the kind."""
    return F.col("mask").bitwiseAND(F.get(F.lit([1 << k for k in range(len(KINDS))]), kind)) != 0


def accepted(scored: DataFrame) -> DataFrame:
    """``pattern, kind, score`` of the patterns that are trusted: a pattern has
    one kind at most, as ``MIN_SCORE`` is over half."""
    each = F.array(*[F.struct(F.lit(k).alias("kind"), F.col(f"s{k}").alias("s")) for k in range(len(KINDS))])
    best = scored.select("pattern", "n", F.explode(each).alias("b")).select(
        "pattern", "b.kind", "b.s", F.floor(F.col("b.s") / (F.col("n") + PRIOR)).cast("int").alias("score"))
    return best.where((F.col("score") >= MIN_SCORE) & (F.col("s") >= MIN_SUPPORT)).drop("s")


def learn_patterns(edges: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """The accepted patterns after ``rounds`` of scoring patterns by instances
    and instances by patterns; seeds keep the full score of their kind."""
    seeds = edges.where("kind >= 0").groupBy("pattern").agg(
        F.count("*").alias("n"), *[F.sum(s).alias(f"s{k}") for k, s in enumerate(_scores(F.col("kind")))])
    seeds = save(seeds, "seed-patterns")
    loose_edges = save(edges.where("kind < 0").select("pattern", "value", "mask"), "loose-edges")
    sums = [F.sum(f"s{k}").alias(f"s{k}") for k in range(len(KINDS))]
    nothing = [F.lit(0).cast("long").alias(f"s{k}") for k in range(len(KINDS))]
    open_ = loose_edges.groupBy("pattern").agg(F.count("*").alias("n")).select("pattern", "n", *nothing)
    # Only patterns of a seed can be trusted in the first round.
    patterns = save(accepted(seeds.union(open_.join(seeds, "pattern", "left_semi")).groupBy("pattern").agg(
        F.sum("n").alias("n"), *sums)), "patterns")
    for _ in range(rounds - 1):
        hit = loose_edges.join(patterns, "pattern").where(
            _possible(F.col("kind")))
        best = hit.groupBy("value").agg(F.max(F.struct("score", (-F.col("kind")).alias("less"))).alias("b"))
        best = save(best.select("value", F.col("b.score").alias("score"), (-F.col("b.less")).alias("kind")), "instances")
        learned = loose_edges.join(best, "value").groupBy("pattern").agg(
            F.lit(0).cast("long").alias("n"),
            *[F.sum(F.when(F.col("kind") == k, F.col("score")).otherwise(0)).alias(f"s{k}") for k in range(len(KINDS))])
        after = save(accepted(seeds.union(open_).union(learned).groupBy("pattern").agg(
            F.sum("n").alias("n"), *sums)), "patterns")
        drop(best, patterns)
        patterns = after
    drop(seeds, loose_edges)
    return patterns


def added_spans(found: DataFrame, patterns: DataFrame) -> DataFrame:
    """``row, added``: the loose strings in an accepted pattern of a kind that
    they can be, each with the kind of the best one."""
    s = found.select("row", F.explode("slots").alias("s")).where("s.kind < 0")
    each = s.select("row", F.explode("s.patterns").alias("pattern"), "s.mask", "s.start", "s.end")
    hit = each.join(patterns, "pattern").where(_possible(F.col("kind")))
    best = hit.groupBy("row", "start", "end").agg(
        F.max(F.struct("score", (-F.col("kind")).alias("less"))).alias("b"))
    return best.groupBy("row").agg(F.collect_list(
        F.struct((-F.col("b.less")).alias("kind"), "start", "end")).alias("added"))     # of one text


def _number(kind: int) -> Column:
    return F.size(F.filter("base", lambda x: x["kind"] == kind)).cast("long")


def personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  rounds: int = ROUNDS) -> DataFrame:
    """Per row: id, ``n_email``, ``n_ip``, ``n_card``, ``n_phone`` (base spans),
    ``base_sha256``, ``spans`` (base and added ones) and ``n_added``.

    A null text is an empty one and has no span; a null id stays null; repeated
    rows are rows of their own, but their instances count once for a pattern; an
    empty table gives an empty result.  Only the two named columns are read.
    """
    found = save(scanned(docs, id_col, text_col), "found")
    edges = save(edges_of(found), "edges")
    patterns = learn_patterns(edges, rounds)
    drop(edges)
    added = save(added_spans(found, patterns), "added")
    drop(patterns)
    rows = found.select("row", "id", "base").join(added, "row", "left")
    names = F.lit(list(KINDS))

    def shown(spans: Column) -> Column:
        return F.array_join(F.transform(F.array_sort(spans), lambda x: F.concat_ws(
            ":", F.get(names, x["kind"]), x["start"], x["end"])), ",")

    own = F.coalesce("added", F.lit([]).cast(f"array<{SPAN}>"))
    return rows.select(
        F.col("id").alias(id_col),
        *[_number(k).alias(f"n_{name}") for k, name in enumerate(KINDS)],
        F.sha2(shown(F.col("base")), 256).alias("base_sha256"),
        shown(F.concat("base", own)).alias("spans"), F.size(own).cast("long").alias("n_added"))
