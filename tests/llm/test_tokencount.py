import math
import time
import tracemalloc

import public_tokenizers
from tripwright.llm import tokencount as T

from .conftest import rows_of


def brute(word, scores):
    token = T.MARKER + word
    best = [(0.0, 0)] + [None] * len(token)
    for i in range(1, len(token) + 1):
        best[i] = max((best[j][0] + scores[token[j:i]], -best[j][1] - 1) for j in range(i) if token[j:i] in scores)
        best[i] = (best[i][0], -best[i][1])
    return best[-1][1]


def test_trie_against_single_words():
    scores = T.piece_scores(public_tokenizers.path("piece_bpe_32k.model"))
    assert all(s < 0 and math.isfinite(s) for s in scores.values())
    words = "the then thence theory a an and ande über überaus 123 1234 é \U0001f600 x xx".split()
    trie = T.Trie(scores)
    assert {w: trie[w.encode()] for w in words} == {w: brute(w.encode(), scores) for w in words}
    nodes = len(trie.best)
    assert trie["thenc".encode()] == brute(b"thenc", scores) and len(trie.best) == nodes   # all shared
    small = T.Trie(scores, max_nodes=5)
    assert [small[w.encode()] for w in words * 2] == [trie[w.encode()] for w in words * 2]


def test_rows(make_docs):
    path = public_tokenizers.path("piece_bpe_32k.model")
    scores = T.piece_scores(path)
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "the the theory"), (4, "the the theory"), (None, "a b über"), (5, "x" * 5000 + " y")]
    want = sorted(((i, len((t or "").encode().split()), sum(brute(w, scores) for w in (t or "").encode().split()),
                    len((t or "").encode())) for i, t in rows), key=repr)
    got = T.token_counts(make_docs(rows), path)
    assert rows_of(got, "doc_id", "n_words", "n_tokens", "n_bytes") == want
    assert T.token_counts(make_docs([]), path).collect() == []


def test_long_words_make_no_nodes():
    scores = T.piece_scores(public_tokenizers.path("piece_bpe_32k.model"))
    trie = T.Trie(scores)
    text = "".join(chr(97 + i * i % 26) for i in range(T.LONG * 3))
    for word in (text.encode(), b"a" * (T.LONG + 1), ("\u00fcber" * T.LONG).encode()):
        nodes = len(trie.best)
        assert trie[word] == brute(word, scores) and len(trie.best) == nodes and word not in trie
    for word in (b"ab" * 20, text[:T.LONG].encode()):        # short ones agree either way
        assert trie.of_long(word) == trie[word]
    tracemalloc.start()
    start = time.time()
    assert trie[b"ab" * 500_000] > 0
    assert time.time() - start < 60 and tracemalloc.get_traced_memory()[1] < 20e6
    tracemalloc.stop()
