import hashlib
import re
from itertools import permutations

from tripwright.llm import interaction as I

from .conftest import rows_of

COLUMNS = ("part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost",
           "shapley")


def masks(rows):
    first = {}
    for i, text, _ in rows:
        if i is not None:
            first[text or ""] = min(i, first.get(text or "", i))
    for i, text, lang in rows:
        t = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        yield (lang or "", i, (len(words) < 200, 100 * len(set(words)) < 50 * len(words),
                               100 * len(re.findall("[A-Z]", t)) > 3 * len(t), bool(re.search(r"[#$%&*|]", t)),
                               i is not None and i > first[t]))


def brute(rows, labels):
    docs = list(masks(rows))
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, x in labels if x == 1 and i is not None}
    out, shapley = [], {}
    for part in {d[0] for d in docs}:
        for order in map("".join, permutations("ABCDE")):
            left = [d for d in docs if d[0] == part]
            gone = []
            for step, f in enumerate(order, 1):
                k = "ABCDE".index(f)
                hit = [d for d in left if d[2][k]]
                left = [d for d in left if not d[2][k]]
                out.append([part, order, step, len(left), len(hit), sum(d[2][k] for d in gone),
                            sum(d[0] == part and d[2][k] and sum(d[2]) == 1 for d in docs),
                            sum(d[1] in good for d in hit), sum(d[1] in toxic for d in hit)])
                gone += hit
                shapley[part, f] = shapley.get((part, f), 0) + len(hit)
    return sorted((tuple(r + [shapley[r[0], r[1][r[2] - 1]]]) for r in out), key=repr)


def corpus():
    long = " ".join(f"w{i}" for i in range(250))
    few = " ".join(f"w{i % 9}" for i in range(250))
    texts = [None, "", "\n", long, long + " A" * 90, long + " | x", few, few + " #", "x" * 50_000, long.upper(), "É" * 10 + "AB",
             "  " + long + "\v", few + " B" * 200]
    rows = [(i, t, ("en", "de", None, "")[i % 4]) for i, t in enumerate(texts * 4)]
    rows += [(3, long, "en"), (3, long, "en"), (None, long, "fr"), (None, None, None), (-5, few, "de"), (90, "own text", "en")]
    return rows


LABELS = [(3, 1, 0), (3, 0, 1), (5, 0, 1), (6, 1, 1), (16, None, 1), (20, 1, None), (None, 1, 1), (999, 1, 1), (31, 1, 0)]


def tables(spark, rows, labels=LABELS):
    docs = spark.createDataFrame([(*r, "clash", "clash", "clash") for r in rows],
                                 "doc_id long, text string, lang string, part string, mask string, digest string")
    return docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_against_brute_force(spark):
    rows = corpus()
    assert rows_of(I.interactions(*tables(spark, rows)), *COLUMNS) == brute(rows, LABELS)


def test_empty_tables(spark):
    assert I.interactions(*tables(spark, [])).collect() == []
    rows = corpus()[:5]
    assert rows_of(I.interactions(*tables(spark, rows, [])), *COLUMNS) == brute(rows, [])


def test_sketch_clears_no_copy(spark, monkeypatch):
    """A text that occurs twice is never cleared, one that occurs once mostly
    is; a sketch that is far too small clears little and loses nothing."""
    digests = [hashlib.sha256(str(i % 3000 if i < 3300 else i).encode()).digest() for i in range(6000)]
    rows = spark.createDataFrame([(i, d) for i, d in enumerate(digests)], "id long, digest binary").repartition(7)
    twice = {i for i, d in enumerate(digests) if digests.count(d) > 1}
    maybe = {r.id for r in I.possible_repeats(rows).collect()}
    assert twice <= maybe and len(maybe) < len(twice) + 600
    monkeypatch.setattr(I, "LEAST_COUNTERS", 1 << 10)
    monkeypatch.setattr(I, "MOST_COUNTERS", 1 << 10)
    monkeypatch.setattr(I, "SLICE", 1 << 8)
    assert twice <= {r.id for r in I.possible_repeats(rows).collect()}


def test_sketch_size_is_bounded():
    assert I.counters_for(0) == I.LEAST_COUNTERS
    assert I.counters_for(1_000_000) == 1 << 23
    assert I.counters_for(10 ** 12) == I.MOST_COUNTERS
