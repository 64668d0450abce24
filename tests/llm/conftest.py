import pytest

SF = "/root/testdata/sf0.001"
# Columns whose names an operator might use itself.
CLASHING = ("id", "k1", "k2", "fp", "n", "x", "t", "row", "lines", "words", "hits", "item_id", "gone",
            "spans", "__doc", "bucket", "label", "count", "pos")


@pytest.fixture(scope="session", autouse=True)
def workers(spark):
    from tripwright.llm.common import worker_path
    worker_path(spark)


@pytest.fixture()
def make_docs(spark):
    """Documents from (doc_id, text) pairs with columns of clashing names."""
    def make(rows, clash=True):
        extra = CLASHING if clash else ()
        schema = "doc_id long, text string, lang string, source string, n_chars long" + "".join(
            f", `{c}` string" for c in extra)
        return spark.createDataFrame(
            [(i, t, "en", "src1", len(t or ""), *["clash"] * len(extra)) for i, t in rows], schema)
    return make


def rows_of(df, *cols):
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)
