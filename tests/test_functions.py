import hashlib

import pytest
from pyspark.sql import functions as F

from tripwright.functions import geo, keys, timeparts
from helpers import stage_df, ts


def one(df, col):
    return df.select(col.alias("v")).first()["v"]


def test_point_xy(spark):
    df = spark.createDataFrame([("POINT (8.123456789012345 44.98765432109876)",), (None,)], "p string")
    x, y = geo.point_xy("p")
    got = [tuple(r) for r in df.select(x, y).collect()]
    assert got == [(8.123456789012345, 44.98765432109876), (None, None)]


@pytest.mark.parametrize("text,value", [
    ("45.0", 45.0), ("-7", -7.0), ("+.5", 0.5), ("1.", 1.0), ("1e3", 1000.0), ("2E-1", 0.2), ("45.0d", None), ("1f", None),
    ("0x1p3", None), ("NaN", None), ("Infinity", None), ("-inf", None), ("1e400", None), ("", None), (" 1", None), ("1 ", None),
    ("1e", None), (".", None)])
def test_coordinate_grammar(spark, text, value):
    assert one(spark.createDataFrame([(text,)], "p string"), geo.coordinate("p")) == value


@pytest.mark.parametrize("text", ["POINT (7.1)", "POINT ()", "", "POINT (45.0d 1)", "POINT (1 NaN)"])
def test_parse_point_malformed(spark, text):
    df = spark.createDataFrame([(text,)], "p string")
    with pytest.raises(Exception):
        one(df, F.struct(*geo.point_xy("p", strict=True)))
    lenient = one(df, F.struct(*geo.point_xy("p", strict=False)))
    assert lenient[0] is None or lenient[1] is None
    assert one(df, geo.point_is_valid("p")) is False


def test_case_lower_null_semantics(spark):
    df = spark.createDataFrame([(1.0, None), (None, 2.0), (3.0, 1.0)], "a double, b double")
    got = [r["v"] for r in df.select(geo.case_lower("a", "b").alias("v")).collect()]
    # CASE WHEN a < b THEN a ELSE b: NULL b -> NULL, NULL a -> b (least would skip NULLs)
    assert got == [None, 2.0, 1.0]


def test_box_contains_edges_inclusive(spark):
    df = spark.createDataFrame([((0.0, 0.0, 2.0, 2.0),)], "b struct<x0:double,y0:double,x1:double,y1:double>")
    for (x, y), want in [((0.0, 1.0), True), ((2.0, 2.0), True), ((2.0000001, 1.0), False),
                         ((1.0, -0.1), False)]:
        assert one(df, geo.box_contains("b", x, y)) is want


def test_event_id_is_md5_of_dash_joined_text(spark):
    df = stage_df(spark, [("Vienna", "POINT (1 2)", "POINT (3 4)", "2018-05-01 00:00:00", "app")])
    got = bytes(one(df, keys.event_id()))
    want = hashlib.md5(b"Vienna-app-POINT (1 2)-POINT (3 4)").digest()
    assert got == want
    assert one(df, keys.event_id_hex(keys.event_id())) == want.hex()


def test_event_id_skips_null_fields(spark):
    df = stage_df(spark, [("Vienna", "POINT (1 2)", None, "2018-05-01 00:00:00", "app")])
    want = hashlib.md5(b"Vienna-app-POINT (1 2)-").digest()
    assert bytes(one(df, keys.event_id())) == want


def test_day_start_keeps_ntz(spark):
    df = stage_df(spark, [("r", None, None, "2018-05-06 23:59:59", "s")])
    out = df.select(timeparts.day_start("datetime").alias("d"))
    assert out.schema["d"].dataType.typeName() == "timestamp_ntz"
    assert out.first()["d"] == ts("2018-05-06 00:00:00")


@pytest.mark.parametrize("when,week,year,weekday", [
    ("2018-12-31 10:00:00", 1, 2018, 1),
    ("2021-01-03 10:00:00", 53, 2021, 7),
    ("2018-05-06 00:00:00", 18, 2018, 7),
])
def test_iso_week_and_weekday(spark, when, week, year, weekday):
    df = stage_df(spark, [("r", None, None, when, "s")])
    row = df.select(*timeparts.event_time_parts("datetime")).first()
    assert (row["week"], row["year"], row["weekday"]) == (week, year, weekday)


def test_format_timestamp_as_written_uses_12h_and_month(spark):
    df = stage_df(spark, [("r", None, None, "2018-05-07 15:42:07", "s")])
    assert one(df, timeparts.format_timestamp("datetime")) == "2018-05-07 15:42:07"
    assert one(df, timeparts.format_timestamp("datetime", as_written=True)) == "2018-05-07 03:05:07"
    assert one(df, timeparts.format_day("datetime")) == "2018-05-07"


def test_formatting_ignores_session_time_zone(spark):
    df = stage_df(spark, [("r", None, None, "2018-03-11 02:30:05", "s")])
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")  # 02:30 is a DST gap
        assert one(df, timeparts.format_timestamp("datetime")) == "2018-03-11 02:30:05"
        assert one(df, timeparts.format_day("datetime")) == "2018-03-11"
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_strict_parse_raises_without_ansi(spark):
    df = spark.createDataFrame([("POINT (7.1)",)], "p string")
    old = spark.conf.get("spark.sql.ansi.enabled")
    try:
        spark.conf.set("spark.sql.ansi.enabled", "false")
        with pytest.raises(Exception):
            one(df, F.struct(*geo.point_xy("p", strict=True)))
    finally:
        spark.conf.set("spark.sql.ansi.enabled", old)
