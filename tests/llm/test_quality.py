import numpy as np
from pyspark.sql import functions as F
from tripwright.llm import quality as Q
from tripwright.llm.common import read

from .conftest import SF, rows_of


def brute(text):
    text = text or ""
    words = [w for w in text.translate({c: " " for c in (9, 10, 11, 12, 13)}).split(" ") if w]
    lines = [x for x in text.split("\n") if x.strip(" \t\v\f\r")]
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    covered = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(3)}
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text),
            sum(x in lines[:i] for i, x in enumerate(lines)), len(covered))


TEXTS = ["", " \n\t", "a", "a b c a b c", "a a a a a", "x y\nx y\n\n\nx y", "é è ## <b>|", "a b c d " * 30,
         "one\r\ntwo\x0bthree\x0cfour", "\n".join(["same line here"] * 5), "a b c x a b c b c x a b"]


def test_statistics():
    for t in [*TEXTS, None]:
        assert Q.text_stats(t)[:5] == brute(t), t


def test_judge_rows(make_docs, spark):
    rows = [*enumerate(TEXTS), (100, None), (None, "null id " * 60), (5, "x y\nx y\n\n\nx y"), (5, "other")]
    got = Q.judge(make_docs(rows), [])
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    want = []
    for i, t in rows:
        s = brute(t)
        failed = s[0] < 50 or 100 * s[4] > 50 * s[0]
        want.append((i, *s, failed, not failed))
    assert rows_of(got, "doc_id", *names, "base_failed", "kept") == sorted(want, key=repr)
    assert [f.dataType.simpleString() for f in got.schema.fields[:8]] == ["bigint"] * 6 + ["boolean"] * 2
    assert Q.judge(make_docs([]), []).collect() == []


def test_learns_an_ordered_list():
    rng = np.random.default_rng(1)
    n = 3000
    rows = np.stack([rng.integers(60, 400, n), rng.integers(300, 3000, n), rng.integers(0, 3, n), np.zeros(n),
                     rng.integers(0, 10, n), rng.integers(0, 30, n), np.zeros(n), rng.integers(50, 60, n)], axis=1)
    bad = rng.random(n) < 0.2
    rows[bad, 2] = rows[bad, 0]                   # as many symbols as words
    rules = Q.learn(rows, ~bad, rng.random(n) < 0.3)
    assert rules[-1].conditions == () and all(r.conditions for r in rules[:-1])
    assert (decide(rows, rules) == ~bad).mean() > 0.99


def decide(rows, rules):
    """The first rule that holds, row by row."""
    x = Q.features(rows)
    out = np.ones(len(x), bool)
    for i in range(len(x)):
        out[i] = next((r.keep for r in rules if Q._covered(x[i:i + 1], r.conditions)[0]), True)
    return out


def exceptions():
    """Many marks are bad, unless much is repeated; nothing tells the rest."""
    rng = np.random.default_rng(5)
    n = 6000
    words = rng.integers(60, 1000, n)
    marks, repeats = (np.where(rng.random(n) < 0.3, words, 0) for _ in range(2))
    zero = np.zeros(n)
    rows = np.stack([words, words * 5, zero, zero, repeats, zero, marks, words], axis=1)
    good = np.where(repeats > 0, True, np.where(marks > 0, False, rng.random(n) < 0.7))
    return rows, good, rng.random(n) < 0.4


def test_order_of_rules_decides():
    """Both classes have rules, and another order gives other verdicts."""
    rows, good, held = exceptions()
    rules = Q.learn(rows, good, held)
    assert {r.keep for r in rules[:-1]} == {True, False}
    got = decide(rows, rules)
    told = (rows[:, 4] > 0) | (rows[:, 6] > 0)
    assert (got == good)[told].mean() > 0.98 and got[~told].mean() > 0.9
    other = [*sorted(rules[:-1], key=lambda r: r.keep), rules[-1]], [*sorted(rules[:-1], key=lambda r: not r.keep), rules[-1]]
    assert any((decide(rows, o) != got).any() for o in other)


def test_list_as_a_case_expression(spark):
    rows, good, held = exceptions()
    rules = Q.learn(rows, good, held)
    want = decide(rows[:400], rules)
    df = spark.createDataFrame([(i, *map(int, r)) for i, r in enumerate(rows[:400])], "i long, " + ", ".join(f"{n} long" for n in Q.STATS))
    got = df.select("i", Q.verdict(F.struct(*Q.STATS), rules).alias("keep")).orderBy("i").collect()
    assert [r.keep for r in got] == want.tolist()


def test_ties_and_one_class():
    """Rows alike in all features, or of one class, teach no rule."""
    alike = np.tile(np.array([100, 500, 3, 0, 0, 1, 0, 60]), (200, 1))
    held = np.arange(200) % 3 == 0
    assert Q.learn(alike, np.arange(200) % 2 == 0, held) == []
    for one in (np.ones(200, bool), np.zeros(200, bool)):
        assert Q.learn(exceptions()[0][:200], one, held) == []


def test_no_labels_reject_nothing(make_docs, spark):
    labels = spark.createDataFrame([], "doc_id long, quality int")
    assert Q.train(make_docs([(1, "a b c")]), labels) == []
    nulls = spark.createDataFrame([(None, 1), (1, None), (1, 1), (1, 1)], "doc_id long, quality int")
    assert Q.train(make_docs([(1, "a b c"), (None, "x"), (1, None)]), nulls) == []


def test_data_and_expression(spark):
    docs, labels = read(spark, SF.replace("0.001", "0.1"), "documents"), read(spark, SF.replace("0.001", "0.1"), "labels")
    rules = Q.train(docs, labels)
    assert rules
    got = Q.judge(docs, rules).join(labels, "doc_id").where("not base_failed").groupBy("quality", "kept").count()
    n = {(r.quality, r.kept): r["count"] for r in got.collect()}
    assert n.get((1, False), 0) <= 0.01 * n[1, True]
    assert n.get((0, True), 0) <= 0.2 * n[0, False]
    kept = Q.keep_good(docs, rules)
    assert kept.columns == docs.columns
    assert kept.count() == Q.judge(docs, rules).where("kept").count()
