import random
import re

from pyspark.sql import functions as F
from tripwright.llm import secrets as R
from tripwright.llm.common import read

from .conftest import SF


def test_held_out_findings(spark):
    """Precision and recall on the candidates that are never labelled, against
    what was planted."""
    docs = read(spark, SF.replace("0.001", "0.1"), "documents")
    got = R.scan(docs)
    held = {r.candidate for r in got.where(R.never_labelled(F.col("candidate"))).collect()}
    rows = got.collect()
    planted = set()
    for r in docs.select("doc_id", "text").collect():
        planted |= {(r.doc_id, m) for m in re.findall(r'(?i)token = "([0-9a-f]{40})"', r.text)}
    assert planted and held and all(r.label is None for r in rows if r.candidate in held)
    assert 0.5 < sum(r.label is not None for r in rows) / len(rows) < 0.95
    said = {(r.doc_id, r.candidate) for r in rows if r.is_secret and r.candidate in held}
    true = {x for x in planted if x[1] in held}
    assert len(true) > 10 and len(said & true) >= 0.95 * len(true) and len(said & true) >= 0.95 * len(said)
    assert planted <= {(r.doc_id, r.candidate) for r in rows if r.is_secret}
    for r in rows[:200]:
        assert 0 <= r.probability <= 1 and r.length == len(r.candidate) >= R.MIN_RUN


def test_forest_removes_what_the_rule_passes(spark, make_docs):
    """Values that a credential's name promises, and that are made of words like
    those in prose: the rule says secret, the forest does not; keys without any
    name are found all the same."""
    rng = random.Random(8)
    letters = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"
    words = "account service access member country project station balance quarter message".split()

    def key():
        return "".join(rng.choice(letters) for _ in range(32))

    def phrase():
        return "-".join(rng.choice(words) for _ in range(4))

    prose = lambda: " ".join(rng.choice(words) for _ in range(8))
    rows = [(i, f'{prose()} token = "{key()}" {prose()}') for i in range(150)]
    rows += [(200 + i, f"{prose()} {phrase()} {prose()}") for i in range(150)]
    false = [(400 + i, f'{prose()} password = "{phrase()}" {prose()}') for i in range(12)]
    bare = [(500 + i, f"{prose()} -- {key()} -- {prose()}") for i in range(20)]
    got = R.scan(make_docs(rows + false + bare)).collect()
    by_doc = {r.doc_id: r for r in got}
    labels = {r.id: r.label for r in R.candidates(make_docs(false + bare), "doc_id", "text").withColumn(
        "label", R.weak_labels(None)).collect()}
    assert all(labels[i] == 1.0 for i, _ in false) and all(labels[i] is None for i, _ in bare)
    assert sum(by_doc[i].is_secret for i, _ in false) <= 1
    assert sum(by_doc[i].is_secret for i, _ in bare) >= 19
    held = [r for r in got if r.doc_id < 400 and r.label is None]
    right = sum(r.is_secret == (r.doc_id < 200) for r in held)
    assert len(held) > 40 and right >= 0.95 * len(held)


def test_dictionary_is_a_share_of_the_corpus(spark, make_docs):
    rows = [(i, "common words here " + f"rare{'abcdefghij'[i % 10]}{'klmnopqrst'[i // 10]}") for i in range(100)]
    for copies in (1, 5):
        docs = make_docs(rows * copies)
        assert {r.word for r in R.dictionary(docs, "text", 0.05).collect()} == {"common", "words", "here"}


def test_edges(make_docs):
    key = "a1B2" * 6
    rows = [(1, None), (2, ""), (3, "no candidate here"), (4, f'token = "{key}" x'), (4, f'token = "{key}" x'),
            (5, f"{key} {key}"), (None, f"key = {key}"), (6, "z" * 5000), (7, f"a\tb\n{key}")]
    got = R.scan(make_docs(rows)).collect()
    assert sorted(((r.doc_id, r.word_no) for r in got), key=repr) == sorted(
        [(4, 2), (5, 0), (5, 1), (None, 2), (6, 0), (7, 2)], key=repr)
    assert R.scan(make_docs([])).collect() == []


def test_one_class_keeps_everything(make_docs):
    got = R.scan(make_docs([(1, "x" * 30)])).collect()
    assert [(r.probability, r.is_secret) for r in got] == [(None, True)]


def test_main_path_is_native(spark):
    plan = R.scan(read(spark, SF, "documents"))._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))


def test_every_run_of_a_word(make_docs):
    a, b, c = "AKIA" + "Q7b2" * 5, "wJal" + "x9Zk" * 8, "ghp_" + "m3Rt" * 8
    rows = [(1, f'{{"access_key":"{a}","secret_key":"{b}"}}'), (2, f"tokens: {a},{b},{c} end"),
            (3, f"https://host.example/a/long/path/to/some/file.txt?x&token={c}"), (4, f"{a}:{b}"),
            (5, ",".join([a, b] * 2000)), (6, f'token = "{a}"'), (7, "x" * 30)]
    got = R.scan(make_docs(rows)).collect()
    found = {}
    for r in sorted(got, key=lambda r: (r.doc_id, r.word_no, r.run_no)):
        found.setdefault(r.doc_id, []).append(r.candidate)
    assert found == {1: [a, b], 2: [a, b, c], 3: ["example/a/long/path/to/some/file", f"token={c}"], 4: [a, b],
                     5: [a, b] * 2000, 6: [a], 7: ["x" * 30]}
    assert [r.run_no for r in sorted(got, key=lambda r: r.run_no) if r.doc_id == 5] == list(range(4000))
    # Each is labelled by the name just before it.
    labels = R.candidates(make_docs(rows), "doc_id", "text").withColumn("label", R.weak_labels(None)).collect()
    assert {(r.candidate, r.label) for r in labels if r.id in (1, 6)} == {(a, 1.0), (b, 1.0)}
    near = {(r.id, r.run_no): (r.before, r.after) for r in R.candidates(make_docs(rows), "doc_id", "text").collect()}
    assert near[1, 1] == (['","secret_key":"'], None) and near[2, 0] == (["tokens:"], ",") and near[4, 1] == ([":"], None)
