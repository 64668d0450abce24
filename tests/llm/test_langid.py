import time
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import pytest
from tripwright.llm import langid as G
from tripwright.llm.common import read

from .conftest import SF


def test_held_out_accuracy(spark):
    docs = read(spark, SF.replace("0.001", "0.01"), "documents")
    lang = {r.doc_id: (r.lang, r.text) for r in docs.select("doc_id", "lang", "text").collect()}
    got = G.identify(docs).collect()
    assert sorted(r.doc_id for r in got) == sorted(lang)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got)
    assert all(0 <= r.score <= 1 for r in got)
    held = [r for r in got if r.held_out and len(lang[r.doc_id][1]) > 30]
    assert sum(r.lang_pred == lang[r.doc_id][0] for r in held) >= 0.97 * len(held)


def test_edges(make_docs, spark):
    rows = [(1, "the cat and the dog"), (1, "the cat and the dog"), (2, None), (3, ""), (5, "123 $%&"), (None, "the end"), (7, "é" * 3000)]
    got = {r.doc_id: r for r in G.identify(make_docs(rows)).collect()}
    assert all((got[i].lang_pred, got[i].score) == ("und", 0.0) for i in (2, 3, 5))
    assert got[1].lang_pred == got[None].lang_pred == got[7].lang_pred == "en"
    assert not got[None].held_out
    unlabelled = make_docs(rows).selectExpr("doc_id", "text", "cast(null as string) lang")
    assert {r.lang_pred for r in G.identify(unlabelled).collect()} == {"und"}
    assert G.identify(make_docs([])).collect() == []


def test_long_text_in_steps(monkeypatch):
    text = "abc déf " * 500
    whole = sorted(x for g in G.grams(text) for x in g.tolist())
    monkeypatch.setattr(G, "STEP", 100)
    assert sorted(x for g in G.grams(text) for x in g.tolist()) == whole


def test_label_source_and_id_are_no_inputs(spark):
    docs = read(spark, SF, "documents")
    model = G.train(docs.where(~G.held_out()))
    p = docs.select("doc_id", G.predict(docs, model).alias("p"))
    other = docs.selectExpr("-doc_id as doc_id", "text", "'xx' as lang", "'y' as source")
    q = other.select("doc_id", G.predict(other, model).alias("p"))
    assert {r.doc_id: r.p for r in p.collect()} == {-r.doc_id: r.p for r in q.collect()}


def test_batches_against_single_texts():
    """Scores of a batch are those of each text added up gram by gram."""
    rng = np.random.default_rng(1)
    table = np.log(rng.dirichlet(np.ones(G.BUCKETS), 5)).astype(np.float32)
    texts = ["the cat", None, "", "12", "é" * 50, "über den Wolken " * 300, "a", *(f"word {i} " * i for i in range(40))]

    def single(text):
        found = [g for g in G.grams(text or "")]
        if not found:
            return -1, 0.0
        total = table[:, np.concatenate(found)].sum(axis=1, dtype=np.float64)
        return int(total.argmax()), float(1 / np.exp(total - total.max()).sum())
    want = [single(t) for t in texts]
    for entries, product in ((1 << 18, 1 << 20), (1, 1), (50, 35)):
        with pytest.MonkeyPatch.context() as m:
            m.setattr(G, "ENTRIES", entries)
            m.setattr(G, "PRODUCT", product)
            got = G.batch_scores(iter(texts), np.ascontiguousarray(table.T))
        assert [i for i, _ in got] == [i for i, _ in want]
        assert np.allclose([s for _, s in got], [s for _, s in want])


def test_memory_of_a_long_text_and_many_languages():
    table = np.zeros((G.BUCKETS, G.MAX_LANGUAGES), np.float32)
    text = "".join(chr(97 + (i * i) % 26) + " "[i % 5:] for i in range(2_000_000))
    tracemalloc.start()
    start = time.time()
    assert G.batch_scores([text], table)[0][0] == 0
    assert time.time() - start < 60 and tracemalloc.get_traced_memory()[1] < 300e6
    tracemalloc.stop()


def test_sample_is_bounded_and_whole_for_small_languages(spark):
    rows = [(i, "big", f"text {i}") for i in range(6000)] + [(i, "small", f"text {i}") for i in range(90)]
    rows += [(7, "hot", "same")] * 500
    named = spark.createDataFrame(rows, "id long, lang string, text string")
    n = Counter(r.lang for r in G.sample(named, bound=1000).collect())
    assert 750 < n["big"] <= 1000 and n["small"] == 90 and n["hot"] == 1
    plan = G.sample(named, bound=1000)._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan


def test_more_labels_than_are_learned(spark, monkeypatch):
    monkeypatch.setattr(G, "MAX_LANGUAGES", 2)
    words = {"en": "the cat and the dog", "de": "der hund und die katze", "xx": "zzz"}
    rows = [(i, f"{words[lang]} {i}", lang) for lang, n in (("en", 40), ("de", 30), ("xx", 1)) for i in range(n)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert {r.lang_pred for r in G.identify(docs).collect()} == {"en", "de"}
