import hashlib
import random
from collections import Counter

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from tripwright.llm import suffix as X

from .conftest import rows_of


def brute(rows, length):
    texts = [(t or "").encode() for _, t in rows]
    times = Counter(t[i:i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for (doc, _), t in zip(rows, texts):
        gone = np.zeros(len(t), bool)
        for i in range(len(t) - length + 1):
            if times[t[i:i + length]] > 1:
                gone[i:i + length] = True
        spans = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        rest = bytes(b for b, g in zip(t, gone) if not g)
        out.append((doc, len(t), int(gone.sum()), spans, hashlib.sha256(rest).hexdigest()))
    return sorted(out, key=repr)


COLUMNS = ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def corpus(seed=1):
    rng = random.Random(seed)
    words = ["al", "bet", "gam", "delta", "épsilon", "zeta", "eta", "iota"]
    text = lambda n: " ".join(rng.choice(words) for _ in range(n))
    passages = [text(rng.randrange(8, 60)) for _ in range(6)]
    rows = []
    for i in range(70):
        body = text(rng.randrange(0, 60)) + rng.choice(passages) + text(rng.randrange(0, 40))
        if rng.random() < 0.3:
            body += rng.choice(passages) + "!"
        rows.append((i, body))
    rows += [(200, None), (201, ""), (202, "short"), (None, rows[0][1]), (203, "ab" * 300), (204, "x" * 500),
             (205, rows[3][1]), (205, rows[3][1]), (206, rows[4][1]), (206, "other" + rows[4][1][:50])]
    return rows


def test_against_brute_force(make_docs):
    rows = corpus()
    got = X.remove_repeats(make_docs(rows), length=40)
    assert rows_of(got, *COLUMNS) == brute(rows, 40)


def test_hot_grams_are_dealt_by_content(make_docs, monkeypatch):
    monkeypatch.setattr(X, "HOT", 2)
    rows = corpus(7)
    assert rows_of(X.remove_repeats(make_docs(rows), length=40), *COLUMNS) == brute(rows, 40)


def test_full_length_and_rest(make_docs):
    rng = random.Random(9)
    text = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    shared = text(230)
    rows = [(1, text(100) + shared + text(80)), (2, text(20) + shared), (3, shared[:200]), (4, shared[:199]), (5, text(600))]
    got = X.remove_repeats(make_docs(rows), with_rest=True)
    assert rows_of(got, *COLUMNS) == brute(rows, 200)
    assert {r.doc_id: len(r.rest) for r in got.collect()}[3] == 0
    assert X.remove_repeats(make_docs([])).collect() == []


def test_long_texts_over_several_steps(make_docs, monkeypatch):
    rng = random.Random(10)
    big = "".join(rng.choice("abcd") for _ in range(9000))
    monkeypatch.setattr(X, "STEP", 1000)
    parts = [X.anchors_of(t.encode(), 60) for t in (big, big[1234:])]
    covered = [[(l, h) for l, h in zip(p[2], p[3])] for p in parts]
    for spans, n in zip(covered, (9000, 9000 - 1234)):
        assert spans[0][0] == 0 and spans[-1][1] == n - 60
        assert all(a[1] + 1 == b[0] for a, b in zip(spans, spans[1:]))
    # The same window selects the same gram in both, wherever steps begin.
    at = [np.repeat(p[1], p[3] - p[2] + 1) for p in parts]
    assert (at[0][1234:] - 1234 == at[1]).all()


@settings(max_examples=50, deadline=None)
@given(st.lists(st.binary(min_size=8, max_size=40).map(lambda b: bytes(x % 3 + 97 for x in b)), min_size=1, max_size=25))
def test_suffix_sort(texts):
    data = np.frombuffer(b"".join(texts) + b"z" * 8, np.uint8)
    at = np.arange(len(data) - 7)
    group = np.sort(at % 4)
    order = at[np.argsort(at % 4, kind="stable")]
    s = X.Suffixes(data, 8)
    got = X.merge_sort(order, group, s)
    raw = data.tobytes()
    for g in range(4):
        mine = [raw[i:i + 8] for i in got[group == g]]
        assert mine == sorted(raw[i:i + 8] for i in order[group == g])


def test_false_equal_hashes_are_verified(monkeypatch):
    s = X.Suffixes(np.frombuffer(b"abcdefgh" + b"abcdefgX" + b"abcdefgh", np.uint8), 8)
    monkeypatch.setattr(s, "common", lambda x, y: np.full(len(x), 8))
    assert s.equal(np.array([0, 0]), np.array([8, 16])).tolist() == [False, True]
