import corpus_pipeline as C
import duckdb
import pytest
from tripwright.llm import queries
from tripwright.llm import quality as Q
from tripwright.llm.common import read, save

from . import test_decontam, test_lines, test_simhash
from .conftest import SF
from .test_packing import check


def test_stages_against_brute_force(spark):
    docs = read(spark, SF, "documents")
    rows = {r.doc_id: r.text for r in docs.collect()}
    items = [(r.item_id, r.text) for r in read(spark, SF, "benchmark").collect()]
    rules = Q.train(docs, read(spark, SF, "labels"))
    want = {r.doc_id for r in Q.judge(docs, rules).where("kept").collect()}
    for (name, stage) in C.STAGES:
        out = save(stage(spark, docs, SF), name)
        if name == "best_fit_packing":
            check(sorted(rows.items()), out.collect(), 2048)
            break
        assert out.columns == docs.columns, name
        got = {r.doc_id: r.text for r in out.collect()}
        if name == "quality_rules":
            rows = {i: rows[i] for i in want}
        elif name == "line_dedup":
            rows = {i: t for i, _, _, t in test_lines.brute(sorted(rows.items()), 3)}
            assert all(r.n_chars == len(r.text) for r in out.collect())
        elif name == "simhash_near_dedup":
            keep = {c for *_, c in test_simhash.brute(sorted(rows.items()))}
            rows = {i: rows[i] for i in keep}
        else:
            dirty = {i for i, *_ in test_decontam.brute(sorted(rows.items()), items, every=False)}
            assert dirty
            rows = {i: t for i, t in rows.items() if i not in dirty}
        assert got == rows, name
        docs = out


def test_run_is_the_stages(spark):
    out = C.run(spark, SF)
    assert out.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    assert 0 < out.select("doc_id").distinct().count() < read(spark, SF, "documents").count()


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_queries_against_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "pages", "labels", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    got = queries.QUERIES[name](spark, SF).toPandas()
    want = con.execute(queries.ORACLE_SQL[name]).df()
    cols = sorted(got.columns)
    assert cols == sorted(want.columns)
    rows = lambda df: sorted(map(tuple, df[cols].astype(object).values.tolist()), key=repr)
    assert rows(got) == rows(want)


def test_every_stage_takes_an_empty_table(spark, tmp_path):
    docs = read(spark, SF, "documents").where("false")
    for name, stage in C.STAGES:
        docs = save(stage(spark, docs, SF), name)
        assert docs.count() == 0
