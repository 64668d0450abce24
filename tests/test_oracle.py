"""Every registered query against its DuckDB oracle on sf0.001."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

SF = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.exists(SF), reason="driver data not present")
def test_all_queries_match_oracle(spark):
    import __spark_entry__ as E
    from compare import compare
    res = compare(spark, SF, [k for k in E.queries() if k in E.oracle_sql()])
    bad = {k: v for k, v in res.items() if v[0] != "OK"}
    assert not bad


@pytest.mark.skipif(not os.path.exists(SF), reason="driver data not present")
def test_entry_smoke(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.columns == ["region", "event_date", "number_of_trips"]
    assert df.count() > 0
