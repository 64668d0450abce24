import pytest

from tripwright.operators import quality as Q
from helpers import stage_df

P = "POINT (1 1)"


def test_key_report_flags_duplicates_and_nulls(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (None, "d")], "k int, v string")
    r = Q.key_report(df, ["k"], "t").first()
    assert (r["row_count"], r["distinct_keys"], r["duplicate_keys"], r["null_key_rows"]) == (4, 3, 1, 1)
    assert r["passed"] is False
    assert [tuple(x) for x in Q.duplicate_keys(df, ["k"]).collect()] == [(1, 2)]


def test_non_empty_and_require(spark):
    full = spark.range(3)
    empty = spark.range(0)
    rep = Q.check_non_empty({"full": full, "empty": empty})
    got = {r["table_name"]: (r["row_count"], r["passed"]) for r in rep.collect()}
    assert got == {"full": (3, True), "empty": (0, False)}
    with pytest.raises(Q.DataQualityError):
        Q.require(rep)
    Q.require(Q.check_non_empty({"full": full}))


def test_month_bounds_half_open(spark):
    s = stage_df(spark, [("r", P, P, "2018-05-01 00:00:00", "a"),
                         ("r", P, P, "2018-06-01 00:00:00", "a")])
    rep = {(r["year"], r["month"]): r["rows_outside"]
           for r in Q.bounds_report(s, "datetime", "2018-05-01", "2018-06-01").collect()}
    assert rep == {(2018, 5): 0, (2018, 6): 1}


def test_length_report_flags_51_chars(spark):
    s = stage_df(spark, [("x" * 51, P, P, "2018-05-01 00:00:00", "a")])
    rep = {r["column_name"]: (r["max_length"], r["rows_over_limit"])
           for r in Q.length_report(s).collect()}
    assert rep["region"] == (51, 1) and rep["datasource"] == (1, 0)


def test_split_malformed(spark):
    s = stage_df(spark, [("r", "POINT (7.1)", P, "2018-05-01 00:00:00", "a"),
                         ("r", P, "POINT ()", "2018-05-01 00:00:01", "a"),
                         ("r", P, "", "2018-05-01 00:00:02", "a"),
                         ("r", P, None, "2018-05-01 00:00:03", "a"),
                         ("r", P, P, None, "a")])
    good, bad = Q.split_malformed(s)
    assert good.count() == 1
    reasons = sorted(r["reason"] for r in bad.collect())
    assert reasons == ["datetime", "destination_coord", "destination_coord", "origin_coord"]
    rep = Q.malformed_report(s).first()
    assert (rep["bad_origin"], rep["bad_destination"], rep["null_datetime"]) == (1, 2, 1)



def test_trailing_blanks_do_not_count(spark):
    s = stage_df(spark, [("R" + " " * 60, P, P, "2018-05-01 00:00:00", "a")])
    assert [r["region"] for r in Q.enforce_lengths(s).collect()] == ["R" + " " * 49]
    good, bad = Q.split_malformed(s)
    assert bad.count() == 0 and good.first()["region"] == "R" + " " * 49
    assert Q.length_report(s).where("rows_over_limit > 0").count() == 0
    assert s.where(Q.outside_bounds(s, "datetime", "2018-05-01", "2018-06-01")).count() == 0


def test_group_total(spark):
    fact, group = spark.range(5), spark.createDataFrame([(3,), (1,)], "number_of_trips long")
    report = Q.group_total_report(fact, {"g": group, "h": group.union(group.limit(1).selectExpr("1L"))})
    assert sorted(map(tuple, report.collect())) == [("g", 5, 4, False), ("h", 5, 5, True)]


def test_non_empty_without_counting(spark):
    report = Q.check_non_empty({"some": spark.range(1000), "none": spark.range(0)}, counted=False)
    assert sorted(map(tuple, report.collect())) == [("none", 0, False), ("some", 1, True)]
    assert "Limit" in report._jdf.queryExecution().optimizedPlan().toString()
