import itertools
import random
import re
import time

from pyspark.sql import functions as F
from tripwright.llm import decontam as D

from .conftest import rows_of


def test_masks_find_every_tolerated_window():
    for gone in itertools.combinations(range(D.WINDOW), D.SUBSTITUTIONS):
        assert any(all(o + k not in gone for k in mask) for mask in D.MASKS
                   for o in range(D.WINDOW - mask[-1])), gone


def tokens(text):
    return [t for t in re.split(r"[\W_]+", (text or "").lower()) if t]


def brute(rows, items, w=12, s=2, every=True):
    """All relative places, or only those with 4 equal tokens in a row (every
    window of 12 tokens of which 2 differ has them)."""
    out = set()
    bodies = [(item, u, {tuple(u[j:j + 4]): j for j in range(len(u) - 3)}) for item, u in (
        (item, tokens(body)) for item, body in items)]
    for doc, text in rows:
        t = tokens(text)
        for item, u, grams in bodies:
            shifts = range(-len(u), len(t) + 1)
            if not every:
                shifts = {i - j for i in range(len(t) - 3) for j in range(len(u) - 3)
                          if t[i] == u[j] and t[i:i + 4] == u[j:j + 4]} if not grams.keys().isdisjoint(
                    zip(t, t[1:], t[2:], t[3:])) else ()
            confirmed = []
            for shift in sorted(shifts):
                same = [0 <= k + shift < len(t) and t[k + shift] == x for k, x in enumerate(u)]
                good = [i for i in range(len(u) - w + 1) if sum(same[i:i + w]) >= w - s]
                if good:
                    a, b = good[0], good[-1] + w
                    confirmed.append((shift, a, b, sum(same[a:b])))
            places = []                   # shifts less than a window apart are one place
            for x in confirmed:
                if places and x[0] - places[-1][-1][0] < w:
                    places[-1].append(x)
                else:
                    places.append([x])
            for place in places:
                shift, a, b, n = max(place, key=lambda x: (x[3], -x[0]))
                out.add((doc, item, a + shift, a, b - a, n))
    return sorted(out, key=repr)


def cases():
    rng = random.Random(4)
    word = lambda: "w%d" % rng.randrange(300)
    items = [(i, " ".join(word() for _ in range(rng.randrange(12, 40)))) for i in range(8)]
    items += [(90, "too short to tell"), (91, None), (92, ""), (None, items[0][1]), (93, items[1][1])]
    rows = [(100, None), (101, ""), (None, "x " + items[2][1])]
    for i in range(60):
        body = items[rng.randrange(8)][1].split()
        cut = body[rng.randrange(0, 8):]
        for _ in range(rng.randrange(0, 4)):
            cut[rng.randrange(len(cut))] = "changed"
        own = [word() for _ in range(rng.randrange(0, 30))]
        at = rng.randrange(len(own) + 1)
        rows.append((i, ", ".join(own[:at]) + "\n" + " ".join(cut).upper() + " -- " + " ".join(own[at:])))
    return rows, items


def test_against_brute_force(make_docs, spark):
    rows, items = cases()
    bench = spark.createDataFrame([(i, t, "clash") for i, t in items], "item_id long, text string, k1 string")
    got = rows_of(D.overlaps(make_docs(rows), bench), "doc_id", "item_id", "doc_token", "item_token", "n_tokens", "n_same")
    want = brute(rows, items)
    assert got == want and want

    docs = make_docs(rows + rows[:3])
    dirty = {r[0] for r in want}
    kept = D.clean(docs, bench)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id for r in kept.collect()), key=repr) == sorted(
        (i for i, _ in rows + rows[:3] if i not in dirty), key=repr)


def test_shuffled_seeds_give_the_same(make_docs, spark, monkeypatch):
    rows, items = cases()
    bench = spark.createDataFrame(items, "item_id long, text string")
    monkeypatch.setattr(D, "MAX_BROADCAST_SEEDS", 3)
    monkeypatch.setattr(D, "MAX_BROADCAST_ROWS", 3)
    assert rows_of(D.overlaps(make_docs(rows), bench), "doc_id", "item_id", "doc_token", "item_token",
                   "n_tokens", "n_same") == brute(rows, items)


def test_empty(make_docs, spark):
    none = spark.createDataFrame([], "item_id long, text string")
    assert D.overlaps(make_docs([(1, "a b")]), none).collect() == []
    assert D.overlaps(make_docs([]), none).collect() == []
    assert D.clean(make_docs([(1, "a b")]), none).count() == 1


def test_repeated_tokens(make_docs, spark):
    """Periodic texts and items: many relative places, one result for those less
    than a window apart, and no more memory than the numbers of the places."""
    items = [(1, "a " * 40), (2, "a b " * 20), (3, "x " * 5 + "y " * 30), (4, "p q r s t u v w k l m n o z " * 3)]
    rows = [(1, "a " * 300), (2, "a b " * 100), (3, "b a " * 90), (4, "y " * 50), (5, "a " * 20 + "b " * 20 + "a " * 20),
            (6, "p q r s t u v w k l m n o z " * 9)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = rows_of(D.overlaps(make_docs(rows), bench), "doc_id", "item_id", "doc_token", "item_token", "n_tokens", "n_same")
    assert got == brute(rows, items)
    start = time.time()
    bench = spark.createDataFrame([(1, "same " * 400)], "item_id long, text string")
    got = D.overlaps(make_docs([(1, "same " * 20_000), (2, "other " * 100_000), (3, "a" + " " * 1_000_000)]), bench).collect()
    assert [(r.doc_id, r.n_same) for r in got] == [(1, 400)] and time.time() - start < 120


def test_hits_are_native(make_docs, spark):
    bench = spark.createDataFrame(cases()[1], "item_id long, text string").select("item_id", D.token_hashes(F.col("text")).alias("t"))
    plan = D.hits(make_docs([(1, "a b")]), bench, "doc_id", "text")._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))
