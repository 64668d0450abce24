import random

import numpy as np
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from tripwright.llm import simhash as S
from tripwright.llm.common import connected, read

from .conftest import SF, rows_of


def brute_fingerprint(text):
    words = [w for w in "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").translate(
        {c: " " for c in (9, 10, 11, 12, 13)}).split(" ") if w]
    grams = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hs = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def brute_groups(fps, reach=2):
    label = list(range(len(fps)))
    changed = True
    while changed:
        changed = False
        for i in range(len(fps)):
            for j in range(len(fps)):
                if (fps[i] ^ fps[j]).bit_count() <= reach and label[j] < label[i]:
                    label[i], changed = label[j], True
    return label


def brute(rows):
    fps = [brute_fingerprint(t) for _, t in rows]
    groups = brute_groups(fps)
    low = {}
    for (i, _), g in zip(rows, groups):
        if i is not None:
            low[g] = min(i, low.get(g, i))
    return sorted(((i, f"{f:016x}", low.get(g)) for (i, _), f, g in zip(rows, fps, groups)), key=repr)


def corpus(n=60):
    rng = random.Random(5)
    vocabulary = ["w%d" % i for i in range(400)]
    texts = [" ".join(rng.choice(vocabulary) for _ in range(rng.randrange(1, 400))) for _ in range(n)]
    for t in texts[:15]:
        for _ in range(4):
            words = t.split(" ")
            words[rng.randrange(len(words))] = "edited"
            texts.append(" ".join(words))
    return list(enumerate(texts))


EDGES = [(1, None), (2, ""), (3, " \t\n"), (4, "One"), (5, "one"), (6, "a B"), (None, "a b"), (7, "É É é"),
         (7, "É É é"), (8, "a a a"), (8, "a a a a"), (9, "x " * 3000), (None, None), (None, "only null here too")]


def test_against_brute_force(make_docs):
    rows = corpus() + EDGES
    got = rows_of(S.near_duplicates(make_docs(rows)), "doc_id", "fingerprint", "component_id")
    assert got == brute(rows)


def test_shards_lose_no_link(spark):
    rng = random.Random(3)
    fps = []
    for _ in range(150):
        f = rng.getrandbits(64)
        fps += [f] + [f ^ 1 << rng.randrange(64) ^ 1 << rng.randrange(64) for _ in range(3)]
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    df = spark.createDataFrame([(f,) for f in set(signed)], "fp long")
    roots = dict(rows_of(connected(S.links(df, shard=16)), "node", "root"))
    groups = brute_groups(fps)
    first = [signed[g] for g in groups]
    for a in range(0, len(fps), 7):
        for b in range(len(fps)):
            joined = roots.get(signed[a], signed[a]) == roots.get(signed[b], signed[b])
            assert joined == (first[a] == first[b])


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(0, 255), min_size=1, max_size=60), st.integers(0, 3))
def test_vantage_tree_is_exact(points, reach):
    points = np.array([p * 0x0101010101 for p in points], np.uint64)
    got = S.close_groups(points, reach, leaf=4)
    assert got.tolist() == brute_groups([int(p) for p in points], reach)


def test_keep_one(make_docs):
    rows = [(i + 1000, t) for i, t in corpus(20)] + EDGES       # ids of their own
    docs = make_docs(rows)
    kept = S.keep_one(docs)
    assert kept.columns == docs.columns
    want = {c for *_, c in brute(rows) if c is not None}
    ids = [r.doc_id for r in kept.collect()]
    assert sorted(i for i in ids if i is not None) == sorted(want)
    assert ids.count(None) == 1               # a component of null ids only


def test_empty(make_docs):
    assert S.near_duplicates(make_docs([])).collect() == []
    assert S.keep_one(make_docs([])).collect() == []


def test_components_of_a_hub_and_a_chain(spark):
    hub = [(0, i) for i in range(1, 200)]
    chain = [(i, i + 1) for i in range(1000, 1100)]
    got = dict(rows_of(connected(spark.createDataFrame(hub + chain + [(5, 5)], "u long, v long")), "node", "root"))
    assert got == {**{i: 0 for i in range(200)}, **{i: 1000 for i in range(1000, 1101)}}


def test_copies_in_data(spark):
    docs = read(spark, SF, "documents")
    by_text = {}
    for r in docs.collect():
        by_text.setdefault(r.text, []).append(r.doc_id)
    got = {r.doc_id: r.component_id for r in S.near_duplicates(docs).collect()}
    assert all(len({got[i] for i in ids}) == 1 for ids in by_text.values())
