"""Records with line breaks: the split reader against Spark's one-task reader."""

import csv
import io
import random

import pytest
from pyspark.sql import functions as F

from tripwright.schemas import TRIPS
from tripwright.sources import csv_records as R
from tripwright.sources.csv_trips import DIALECT, read_trips

WORDS = ["a", "b c", 'say "x"', "two\nlines", "\n", "cr\r\nlf", 'q"\n"q', "", ",", "é", 'end"', '"', '""']


def one_task(spark, path, strict=True):
    return (spark.read.schema(TRIPS).options(**DIALECT, mode="FAILFAST" if strict else "PERMISSIVE")
            .option("multiLine", True).csv(path))


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.fixture()
def small_ranges(spark):
    keys = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    old = {k: spark.conf.get(k) for k in keys}
    spark.conf.set(keys[0], "700")
    spark.conf.set(keys[1], "0")
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def written(rows, end="\n"):
    out = io.StringIO()
    w = csv.writer(out, lineterminator=end)
    w.writerow([f.name for f in TRIPS.fields])
    w.writerows(rows)
    return out.getvalue()


def random_rows(rng, n):
    return [[rng.choice(WORDS) or "x", f"POINT ({i} 1)", rng.choice(WORDS) or "y", f"2018-05-01 08:00:{i % 60:02d}",
             rng.choice(WORDS) or "z"] for i in range(n)]


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_one_file_in_many_tasks(spark, tmp_path, small_ranges, end):
    for seed in range(4):
        path = tmp_path / f"{seed}.csv"
        path.write_text(written(random_rows(random.Random(seed), 120), end), newline="")
        got = read_trips(spark, str(path), multiline=True)
        want = rows_of(one_task(spark, str(path)))
        if end == "\r\n":      # the one-task reader rewrites such breaks in fields too
            got = got.select(*[F.replace(c, F.lit("\r\n"), F.lit("\n")).alias(c) if t == "string" else c for c, t in got.dtypes])
        assert rows_of(got) == want
        records = R.read_records(spark, [str(path)])
        assert records.select(F.spark_partition_id().alias("p")).distinct().count() > 5


def test_a_record_over_many_ranges(spark, tmp_path, small_ranges):
    long = "line\n" * 2000
    rows = [["a", "POINT (1 1)", long, "2018-05-01 08:00:00", "b"], ["c", "d", "e", "2018-05-01 08:00:00", "f\n" * 900]]
    path = tmp_path / "long.csv"
    path.write_text(written([*rows, *random_rows(random.Random(9), 30)]))
    got = read_trips(spark, str(path), multiline=True)
    assert rows_of(got) == rows_of(one_task(spark, str(path))) and any(r.destination_coord == long for r in got.collect())


def test_several_files_empty_ones_and_no_last_line_break(spark, tmp_path, small_ranges):
    for name, text in (("a", written(random_rows(random.Random(1), 50)).rstrip("\n")), ("b", ""), ("c", written([])),
                       ("d", "\n\n" + written(random_rows(random.Random(2), 20)).replace("\n2018", "2018") + "\n\n")):
        (tmp_path / f"{name}.csv").write_text(text)
    assert rows_of(read_trips(spark, str(tmp_path), multiline=True)) == rows_of(one_task(spark, str(tmp_path)))


def test_quotes_inside_plain_fields(spark, tmp_path, small_ranges):
    path = tmp_path / "q.csv"
    path.write_text(written([]) + 'a"b,x,5" tall,2018-05-01 08:00:00,s\n"c\n""d""",x,y,2018-05-01 08:00:00,t"\n' * 40)
    assert rows_of(read_trips(spark, str(path), multiline=True)) == rows_of(one_task(spark, str(path)))


def test_lenient_and_strict(spark, tmp_path):
    path = tmp_path / "bad.csv"
    path.write_text(written([["a", "b", "c", "2018-05-01 08:00:00", "two\nlines"], ["a", "b", "c", "noon", "d\ne"], ["too", "few"]]))
    lenient = read_trips(spark, str(path), strict=False, multiline=True).collect()
    assert sorted(r["_corrupt_record"] for r in lenient if r["_corrupt_record"]) == ['a,b,c,noon,"d\ne"', "too,few"]
    with pytest.raises(Exception):
        read_trips(spark, str(path), multiline=True).collect()


def test_line_states():
    for line, closed, is_open in [("", False, True), ("a,b", False, True), ('a,"b', True, False), ('a,"b"', False, False), ('x",y', False, False),
                                  ('x""', False, True), ('"a""', True, False), ('a"b,c', False, False), ('"a"b,"c', True, True),
                                  ('x","y', True, True)]:
        assert (R.open_after(line, False), R.open_after(line, True)) == (closed, is_open), line
