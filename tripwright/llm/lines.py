"""Line de-duplication by winnowing over line hashes.

The lines of a text that hold a word are hashed.  Of every window of
``min_lines`` consecutive ones the smallest hash is selected as fingerprint, so
two texts that share that many lines in a row share one.  Fingerprints that
occur once are dropped; around the others each window is compared by content
with the first place it occurs at, and windows that match an earlier place are
joined both ways into maximal runs, which are deleted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import drop, marks, save

MIN_LINES = 3
MIN_WORDS = 50             # of fewer lines that count as well
WORD = r"[^\x20\x09-\x0D]"
BLANKS = r"[\x20\x09-\x0D]+"


def repeated_lines(docs: DataFrame, id_col: str, text_col: str, w: int, min_words: int = MIN_WORDS) -> DataFrame:
    """``(k1, k2, gone)``: per row the numbers of the lines that lie in a window
    - ``w`` lines (with a word), or fewer with ``min_words`` words - that occurs
    earlier: by id (null first), row hash and place."""
    k1, k2 = marks(F.col(id_col), F.col(text_col))
    rows = docs.select(F.col(id_col).alias("id"), k1.alias("k1"), k2.alias("k2"), F.filter(
        F.transform(F.split(F.col(text_col), "\n", -1), lambda x, i: F.struct(i.alias("no"), x.alias("line"))),
        lambda x: x["line"].rlike(WORD)).alias("worded")).where(F.size("worded") > 0)
    rows = rows.select("id", "k1", "k2", F.col("worded.line").alias("lines"), F.col("worded.no").alias("numbers"),
                       F.transform("worded", lambda x: F.xxhash64(x["line"])).alias("hashes"),
                       F.transform("worded", lambda x: F.size(F.array_remove(F.split(x["line"], BLANKS, -1), ""))).alias("words"))

    def windows(size: int) -> Column:
        def part(column, i):
            return F.slice(column, i + 1, F.lit(size))

        def selected(i):
            return F.array_position(part("hashes", i), F.array_min(part("hashes", i))) + i

        places = F.when(F.size("hashes") >= size, F.sequence(F.lit(0), F.size("hashes") - size)).otherwise(
            F.array().cast("array<int>"))
        if size < w:
            places = F.filter(places, lambda i: F.aggregate(part("words", i), F.lit(0), lambda a, b: a + b) >= min_words)
        return F.transform(places, lambda i: F.struct(
            i.alias("i"), F.xxhash64(F.lit(size), F.array_min(part("hashes", i))).alias("fp"),
            (F.lit(size < w) | (i == 0) | (selected(i) != selected(i - 1))).alias("first"),
            F.unhex(F.md5(F.concat_ws("\n", part("lines", i)))).alias("key"), part("numbers", i).alias("numbers")))

    # explode_outer: a plain explode would test the whole expression in a pushed filter as well.
    rows = save(rows.select("id", "k1", "k2", F.explode_outer(F.concat(*map(windows, range(1, w + 1)))).alias("x"))
                .where(F.col("x").isNotNull()).select("id", "k1", "k2", "x.*"), "line-windows")
    # Written, like those below, and merged at any size: with plain shuffles on both
    # sides of a join a hot value can be split.
    often = save(rows.where("first").groupBy("fp").count().where("count > 1").select("fp"), "fingerprints-often")
    hit = save(rows.join(often.hint("merge"), "fp").select("fp", "key", "id", "k1", "k2", "i", "numbers"), "line-hits")
    drop(rows, often)
    place = F.struct("id", "k1", "k2", "i")
    origin = save(hit.groupBy("fp", "key").agg(F.min(place).alias("origin"), F.count("*").alias("n"))
                  .where("n > 1").drop("n"), "line-origins")
    return (hit.join(origin.hint("merge"), ["fp", "key"]).where(place > F.col("origin"))
            .groupBy("k1", "k2").agg(F.array_distinct(F.flatten(F.collect_list("numbers"))).alias("gone")))


def marked(docs: DataFrame, id_col: str, text_col: str, w: int) -> DataFrame:
    """``docs`` with ``__lines`` (all lines) and ``__gone`` (numbers of those to
    delete, null for none)."""
    gone = repeated_lines(docs, id_col, text_col, w)
    k1, k2 = marks(F.col(id_col), F.col(text_col))
    rows = docs.withColumns({"__k1": k1, "__k2": k2})
    rows = rows.join(gone.select(F.col("k1").alias("__s1"), F.col("k2").alias("__s2"), F.col("gone").alias("__gone")),
                     (F.col("__k1") == F.col("__s1")) & (F.col("__k2") == F.col("__s2")), "left")
    return rows.withColumn("__lines", F.split(F.col(text_col), "\n", -1))


def _kept_text(text: Column) -> Column:
    kept = F.array_except(F.sequence(F.lit(0), F.size("__lines") - 1), F.col("__gone"))
    return F.when(F.col("__gone").isNull(), text).otherwise(
        F.array_join(F.transform(kept, lambda i: F.get("__lines", i)), "\n"))


def line_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                min_lines: int = MIN_LINES) -> DataFrame:
    """Id, ``n_lines`` (with a word), ``n_deleted`` and the remaining ``text``
    of every row.

    A line is deleted if it lies in ``min_lines`` consecutive lines with a word,
    or in fewer that have ``MIN_WORDS`` words together, that occur, the same and
    in this order, at an earlier place: a smaller id, or further up in the same
    text.  Lines without a word stay and don't break
    a run.  A null text stays null; a null id comes first; rows equal in id and
    text are one row and don't delete each other's lines; an empty table gives
    an empty result.  Only the two named columns are read.
    """
    rows = marked(docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("__text")),
                  "__id", "__text", min_lines)
    return rows.select(F.col("__id").alias(id_col), F.coalesce(F.size(F.filter(
        "__lines", lambda x: x.rlike(WORD))).cast("long"), F.lit(0)).alias("n_lines"),
                       F.coalesce(F.size("__gone").cast("long"), F.lit(0)).alias("n_deleted"),
                       _kept_text(F.col("__text")).alias("text"))


def delete_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 min_lines: int = MIN_LINES) -> DataFrame:
    """``docs`` with the repeated lines of ``line_report`` gone from its text;
    all rows and other columns stay."""
    rows = marked(docs, id_col, text_col, min_lines)
    return rows.withColumn(text_col, _kept_text(F.col(text_col))).select(
        *[F.col(f"`{c}`") for c in docs.columns])


LINE_REPORT_SQL = f"""
WITH lined AS (
  SELECT doc_id, text, string_split(text, chr(10)) AS ls,
         list_filter(range(len(string_split(text, chr(10)))),
                     lambda i: regexp_matches(string_split(text, chr(10))[i + 1], '{WORD}')) AS worded
  FROM documents),
windows AS (
  SELECT doc_id, i, w, list_transform(worded[i + 1:i + w], lambda k: ls[k + 1]) AS content
  FROM (SELECT *, unnest(range(len(worded) - w + 1)) AS i FROM lined, range(1, {MIN_LINES + 1}) AS r(w)
        WHERE len(worded) >= w)),
counted AS (
  SELECT * FROM windows WHERE w = {MIN_LINES} OR list_sum(list_transform(content, lambda x: len(list_filter(
    string_split_regex(x, '{BLANKS}'), lambda y: y <> '')))) >= {MIN_WORDS}),
later AS (
  SELECT doc_id, i, w FROM (
    SELECT doc_id, i, w, row_number() OVER (PARTITION BY content ORDER BY doc_id, i) AS nth FROM counted)
  WHERE nth > 1),
gone AS (
  SELECT doc_id, list(DISTINCT i + o) AS gone
  FROM later, range({MIN_LINES}) AS r(o) WHERE o < w GROUP BY doc_id),
numbered AS (
  SELECT l.*, list_transform(coalesce(g.gone, []::BIGINT[]), lambda k: worded[k + 1]) AS out_no
  FROM lined l LEFT JOIN gone g USING (doc_id))
SELECT doc_id, len(worded)::BIGINT AS n_lines, len(out_no)::BIGINT AS n_deleted,
       CASE WHEN len(out_no) = 0 THEN text ELSE array_to_string(
         list_transform(list_filter(range(len(ls)), lambda i: NOT list_contains(out_no, i)),
                        lambda i: ls[i + 1]), chr(10)) END AS text
FROM numbered
"""
