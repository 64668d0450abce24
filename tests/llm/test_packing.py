import time
import zlib
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tripwright.llm import packing as P
from tripwright.llm.common import read
from tripwright.llm.queries import vocabulary

from .conftest import SF


def reference():
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(vocabulary())
    t.encode_special_tokens = True
    return lambda text: t.encode(text, add_special_tokens=False).ids


def check(rows, got, capacity):
    """Pieces, digests and places of a packing result."""
    encode, want = reference(), []
    for doc, text in rows:
        ids = encode(text or "") + [0]
        first = len(ids) % capacity or capacity
        cuts = [0, *range(first, len(ids) + 1, capacity)]
        for i, (a, b) in enumerate(zip(cuts, cuts[1:])):
            want.append((doc, i, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())))
    assert sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got), key=repr) == sorted(want, key=repr)
    places = defaultdict(list)
    for r in got:
        places[r.sequence_id].append((r.offset, r.length))
    for spans in places.values():
        end = 0
        for offset, length in sorted(spans):
            assert offset == end
            end += length
        assert end <= capacity
    return len(places)


ROWS = [(1, None), (2, ""), (2, ""), (None, "null id"), (3, "word " * 5000), (4, "a  b \n c   d\t\te "), (5, "É" * 300),
        (6, "x" * 3000), (7, "<|endoftext|> is text"), (8, "don't we'll 123 ²⅕"), (9, " lead and trail ")]


@pytest.mark.parametrize("group", [3, 100_000])
def test_round_trip(make_docs, group):
    got = P.pack_documents(make_docs(ROWS), vocabulary(), capacity=64, group=group)
    assert got.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    rows = got.collect()
    n = check(ROWS, rows, 64)
    bound = P.least_bins(np.array([r.length for r in rows]), 64)
    assert bound <= n <= bound + (2 if group == 3 else 1)


def test_data(spark):
    docs = read(spark, SF, "documents")
    got = P.pack_documents(docs, vocabulary()).collect()
    n = check([(r.doc_id, r.text) for r in docs.collect()], got, P.CAPACITY)
    assert n <= P.least_bins(np.array([r.length for r in got])) + 1


def test_sequences_hold_the_ids(make_docs):
    docs = make_docs(ROWS)
    placed = P.pack_documents(docs, vocabulary(), capacity=64)
    made = {r.sequence_id: r.input_ids for r in P.sequences(docs, placed, vocabulary(), capacity=64).collect()}
    for r in placed.collect():
        part = made[r.sequence_id][r.offset:r.offset + r.length]
        assert zlib.crc32(np.array(part, "<u4").tobytes()) == r.ids_crc32
    assert sum(map(len, made.values())) == sum(r.length for r in placed.collect())


def test_empty(make_docs):
    assert P.pack_documents(make_docs([]), vocabulary()).collect() == []


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 20), min_size=1, max_size=9))
def test_bound_and_best_fit(lengths):
    lengths = np.array(lengths)
    at, offset, fill = P.best_fit(lengths, 20)

    def least(items, bins):
        if not items:
            return len(bins)
        best, tried = len(items) + len(bins), set()
        for i, room in enumerate(bins):
            if items[0] <= room and room not in tried:
                tried.add(room)
                best = min(best, least(items[1:], bins[:i] + [room - items[0]] + bins[i + 1:]))
        return min(best, least(items[1:], bins + [20 - items[0]]))

    optimum = least(sorted(lengths.tolist(), reverse=True), [])
    assert P.least_bins(lengths, 20) <= optimum <= len(fill)
    assert fill.tolist() == [int(lengths[at == b].sum()) for b in range(len(fill))] and fill.max() <= 20
    for b in range(len(fill)):
        mine = np.nonzero(at == b)[0]
        assert sorted(offset[mine]) == [0, *np.cumsum(lengths[mine[np.argsort(offset[mine])]])[:-1]]


def test_certified_leftovers_stay(spark):
    """No exchange lowers the bins of pieces over half a bin."""
    items = spark.createDataFrame([(i, 7) for i in range(60)], "doc_id long, length long")
    got = P.pack(items, capacity=10, group=5)
    assert got.select("sequence_id").distinct().count() == 60
    assert got.where(f"sequence_id >= {1 << 59}").count() == 0        # in the first turn


def test_gap_partitions_exchange(spark):
    """Groups that can't be certified alone give back what others complete."""
    items = spark.createDataFrame([(i, 6 if i % 2 else 4) for i in range(200)], "doc_id long, length long")
    got = P.pack(items, capacity=10, group=5)
    assert got.select("sequence_id").distinct().count() <= 106


def test_added_tokens_as_in_tokenizers(spark, make_docs, tmp_path):
    """The query's ids are those of tokenizers at its default settings."""
    import corpus_pipeline
    from tokenizers import Tokenizer
    from tripwright.llm.queries import op5_packing
    rows = [(1, "end<|endoftext|>begin"), (2, "<|endoftext|><|endoftext|>"), (3, " <|endoftext|>  a <|endoftext|"),
            (4, "no such text"), (5, ""), (6, "x<|endoftext|>" * 3000), (7, "<|endof<|endoftext|>text|>")]
    encode = Tokenizer.from_file(vocabulary()).encode
    want = []
    for doc, text in rows:
        ids = [*encode(text, add_special_tokens=False).ids, 0]
        want += [(doc, i, a, n, zlib.crc32(np.array(ids[a:a + n], "<u4").tobytes()))
                 for i, (a, n) in enumerate(P.cut(len(ids), P.CAPACITY))]
    docs = make_docs(rows, clash=False)
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    for got in (op5_packing(spark, str(tmp_path)), corpus_pipeline.best_fit_packing(spark, docs, str(tmp_path))):
        assert sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got.collect()) == want
    made = P.sequences(docs, P.pack_documents(docs, vocabulary(), added=True), vocabulary(), added=True)
    assert sum(len(r.input_ids) for r in made.collect()) == sum(w[3] for w in want)


@pytest.mark.parametrize("added", [False, True])
def test_texts_that_the_fast_coder_refuses(added):
    """Same ids from ``tokenizers``, at its settings for added tokens."""
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(vocabulary())
    t.encode_special_tokens = not added
    encode = P.coder(vocabulary(), added)
    for text in ("a" + " " * 1_000_000 + "b<|endoftext|>", "\n" * 500_000, "word " * 200_000, "x" * 1_000_000):
        start = time.time()
        assert list(encode(text)) == t.encode(text, add_special_tokens=False).ids
        assert time.time() - start < 60


def test_gap_is_reported(make_docs):
    """Rounds go on while they save bins; what a packing lacks to its bound is told."""
    rng = np.random.default_rng(2)
    rows = [(i, " ".join("word" for _ in range(int(rng.integers(1, 60))))) for i in range(600)]
    one = P.pack_documents(make_docs(rows), vocabulary(), capacity=64)
    many = P.pack_documents(make_docs(rows), vocabulary(), capacity=64, group=40)
    for placed in (one, many):
        r = P.gap(placed, 64).first()
        assert r.n_sequences == check(rows, placed.collect(), 64)
        assert r.gap == r.n_sequences - r.lower_bound and 0 <= r.gap <= 0.03 * r.n_sequences
    assert tuple(P.gap(P.pack_documents(make_docs([]), vocabulary())).first()) == (0, 0, 0)
