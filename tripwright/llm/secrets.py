"""Secret scan: candidates by shape, a random forest to remove false positives.

DataFrame and ML-pipeline operations only.  A candidate is a long unbroken run
of key characters; a word, as a whole minified file, may hold many.  Its features are its length, the transitions
between character classes, how much of it is spelled by the corpus' dictionary,
the path it was found at and words before it.  A forest is trained from labelled
findings and gives every candidate a probability.

Labels come from the words next to a candidate, features from what it is made of
and from words further away: the forest can't read a label off its features, so
where a name beside a candidate promises a secret and the value looks like those
in running prose, the forest says so.  A quarter of the different candidates is
never labelled; what the forest says of these measures it.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import marks, save

MIN_RUN = 20                  # key characters in a row
TRAINING_ROWS = 10_000        # bound on the labelled findings of each class
DICTIONARY_RATE = 5e-6        # share of the corpus' words that a word of the dictionary is
DICTIONARY_LETTERS = 4        # letters of its shortest words
DICTIONARY_LONGEST = 20       # and of its longest
NEIGHBOURS = 6                # words before a candidate; one after it
LABEL_NEIGHBOURS = 3          # of these the nearest make labels and are no features
NEIGHBOUR_CHARS = 200         # of a neighbour; a word may be a whole file
NEIGHBOUR_BUCKETS = 32
PATH_BUCKETS = 8
TREES, DEPTH, SEED = 20, 6, 7
THRESHOLD = 0.5

# Fixed values.
RUN = rf"[A-Za-z0-9_+/=-]{{{MIN_RUN},}}"
CREDENTIAL = r"(?i)^\W*(?:api|auth|access|secret|private|client)?[_-]?(?:token|key|secret|password|passwd|pwd|credential|bearer)s?\W*$"
EXAMPLE_PATH = r"(?i)test|example|sample|mock|fixture|demo|docs?\b"

NUMBERS = ["length", "n_classes", "transitions", "longest_same", "digit_share", "upper_share",
           "letter_share", "hex_share", "distinct_share", "dictionary_share", "example_path"]


def _count(text: Column, pattern: str) -> Column:
    """Characters of a text that match a one-character pattern."""
    return F.length(F.regexp_replace(text, f"[^{pattern}]", ""))


def candidates(docs: DataFrame, id_col: str, text_col: str, path_col: str | None = None) -> DataFrame:
    """``(k1, k2, id, path, word_no, run_no, candidate, before, after)``: the
    candidates of every text.  Rows equal in id and text are one.  What stands
    between two runs of a word, and what names a run in its own word, are
    neighbours like words."""
    k1, k2 = marks(F.col(id_col), F.col(text_col))
    path = F.col(path_col).cast("string") if path_col else F.lit(None).cast("string")
    suspect = docs.where(F.col(text_col).rlike(RUN)).select(
        k1.alias("k1"), k2.alias("k2"), F.col(id_col).alias("id"), path.alias("path"),
        F.split(F.col(text_col), r"[\x20\x09-\x0D]+", -1).alias("words"))
    places = F.filter(F.sequence(F.lit(0), F.size("words") - 1), lambda i: (
        F.length(F.get("words", i)) >= MIN_RUN) & F.get("words", i).rlike(RUN))
    near = F.transform(F.col("words"), lambda w: F.substring(w, -NEIGHBOUR_CHARS, NEIGHBOUR_CHARS))
    found = suspect.withColumn("near", near).withColumn("hits", F.transform(places, lambda i: F.struct(
        i.alias("word_no"), F.regexp_extract_all(F.get("words", i), F.lit(RUN), 0).alias("runs"),
        F.split(F.get("words", i), RUN, -1).alias("gaps"),
        F.slice("near", F.greatest(i - NEIGHBOURS, F.lit(0)) + 1, F.least(i, F.lit(NEIGHBOURS))).alias("before"),
        F.substring(F.get("words", i + 1), 1, NEIGHBOUR_CHARS).alias("after"))))
    # explode_outer: a plain explode would test the whole expression in a pushed filter as well.
    words = found.select("k1", "k2", "id", "path", F.explode_outer("hits").alias("x")).where(
        F.col("x").isNotNull()).select("k1", "k2", "id", "path", "x.*")
    runs = words.select("k1", "k2", "id", "path", "word_no", "before", "after", F.explode_outer(F.transform(
        "runs", lambda run, j: F.struct(
            j.alias("run_no"), run.alias("candidate"),
            F.substring(F.get("gaps", j), -NEIGHBOUR_CHARS, NEIGHBOUR_CHARS).alias("lead"),
            F.when(j + 1 < F.size("runs"), F.substring(F.get("gaps", j + 1), 1, NEIGHBOUR_CHARS)).alias("next")))).alias("x"))
    lead = F.col("x.lead")
    led = F.concat("before", F.array(lead))
    return runs.select("k1", "k2", "id", "path", "word_no", "x.run_no", "x.candidate",
                       F.when(lead.rlike(r"[\p{L}=:]"), F.slice(led, F.greatest(F.size(led) - NEIGHBOURS, F.lit(0)) + 1, NEIGHBOURS))
                       .otherwise(F.col("before")).alias("before"),
                       F.coalesce("x.next", "after").alias("after"))


def dictionary(docs: DataFrame, text_col: str, rate: float = DICTIONARY_RATE) -> DataFrame:
    """Letter words (lower case) that are at least ``rate`` of all the corpus'
    words of such a length, whatever its size; one that occurs once is none."""
    words = F.explode(F.split(F.lower(F.col(text_col)), r"[^\p{L}]+", -1))
    counts = save(docs.select(words.alias("word"))
                  .where(F.length("word").between(DICTIONARY_LETTERS, DICTIONARY_LONGEST))
                  .groupBy("word").agg(F.count("*").alias("n")), "word-counts")
    total = counts.agg(F.sum("n")).first()[0] or 0
    return counts.where(F.col("n") >= max(2.0, rate * total)).select("word")


def _coverage(found: DataFrame, words: DataFrame) -> DataFrame:
    """``(spelled, dictionary_share)``: the share of each different candidate's
    characters that lie in a dictionary word in it."""
    each = found.select("candidate").distinct()
    sizes = F.sequence(F.lit(DICTIONARY_LETTERS), F.least(F.length("candidate"), F.lit(DICTIONARY_LONGEST)))
    at = each.select("candidate", F.explode(sizes).alias("size")).select("candidate", "size", F.explode(
        F.sequence(F.lit(1), F.length("candidate") - F.col("size") + 1)).alias("at"))
    # The planner takes the exploded side for as small as the candidates it comes from.
    pieces = at.withColumn("piece", F.lower(F.substring(
        F.col("candidate"), F.col("at"), F.col("size")))).hint("merge")
    known = pieces.join(words, pieces.piece == words.word).select("candidate", F.explode(
        F.sequence(F.col("at"), F.col("at") + F.col("size") - 1)).alias("place")).distinct()
    return known.groupBy(F.col("candidate").alias("spelled")).agg(
        (F.count("*") / F.first(F.length("candidate"))).alias("dictionary_share"))


def features(found: DataFrame, words: DataFrame) -> DataFrame:
    """Adds the numeric features and their vector ``features``."""
    c = F.col("candidate")
    classes = F.regexp_replace(F.regexp_replace(F.regexp_replace(F.regexp_replace(
        c, "[a-z]", "a"), "[A-Z]", "b"), "[0-9]", "0"), "[^ab0]", "-")
    runs = F.regexp_replace(classes, r"(.)\1+", "$1")
    size = F.length(c)
    numbers = {
        "length": size, "n_classes": F.size(F.array_distinct(F.split(classes, ""))),
        "transitions": (F.length(runs) - 1) / size,
        "longest_same": F.array_max(F.transform(F.regexp_extract_all(
            classes, F.lit(r"(a+|b+|0+|-+)"), 0), lambda x: F.length(x))) / size,
        "digit_share": _count(c, "0-9") / size, "upper_share": _count(c, "A-Z") / size,
        "letter_share": _count(c, "A-Za-z") / size, "hex_share": _count(c, "0-9a-fA-F") / size,
        "distinct_share": F.size(F.array_distinct(F.split(c, ""))) / size,
        "example_path": F.coalesce(F.col("path").rlike(EXAMPLE_PATH), F.lit(False)),
    }
    covered = _coverage(found, words)
    rows = found.join(covered, found.candidate == covered.spelled, "left").withColumns(
        numbers | {"dictionary_share": F.coalesce("dictionary_share", F.lit(0.0))})
    far = F.slice("before", 1, F.greatest(F.size("before") - LABEL_NEIGHBOURS, F.lit(0)))
    near = F.transform(far, lambda w: F.pmod(
        F.xxhash64(F.regexp_replace(F.lower(w), r"[^\p{L}=:]", "")), F.lit(NEIGHBOUR_BUCKETS)))
    rows = rows.withColumn("__near", near)
    place = F.pmod(F.xxhash64("path"), F.lit(PATH_BUCKETS))
    vector = F.array(
        *[F.col(n).cast("double") for n in NUMBERS],
        *[F.array_contains("__near", F.lit(b).cast("long")).cast("double") for b in range(NEIGHBOUR_BUCKETS)],
        *[(place == b).cast("double") for b in range(PATH_BUCKETS)])
    return rows.withColumn("features", array_to_vector(vector)).drop("__near", "spelled")


def weak_labels(found: DataFrame) -> Column:
    """Label of a finding where the words next to it tell, whatever it looks
    like: 1 for a value assigned to the name of a credential, 0 for one in running
    prose, between words that name nothing; else null."""
    size = F.size("before")
    near = F.slice("before", F.greatest(size - LABEL_NEIGHBOURS, F.lit(0)) + 1, LABEL_NEIGHBOURS)
    last = F.get("before", size - 1)
    assigned = last.isin("=", ":", "=>", ":=") | last.rlike(r"[=:][\"'`]?$")
    named = F.exists(near, lambda w: w.rlike(CREDENTIAL))
    prose = last.rlike(r"^\p{L}+[.,;!?]*$") & F.coalesce(F.col("after").rlike(r"^\p{L}+[.,;!?]*$"), F.lit(False))
    return F.when(named & assigned, 1.0).when(prose & ~named, 0.0)


def never_labelled(candidate: Column) -> Column:
    """A quarter of all different candidates, by their hash: equal ones are all
    learned from or all held out."""
    return F.pmod(F.xxhash64(candidate, F.lit(11)), F.lit(4)) == 2


def train(labelled: DataFrame, bound: int = TRAINING_ROWS) -> RandomForestClassificationModel | None:
    """A forest from rows with ``features`` and ``label`` (0 or 1): at most
    ``bound`` of each class, those first in the order of a hash.  None if a
    class has no row."""
    order = F.xxhash64("k1", "k2", "word_no")
    part = [labelled.where(F.col("label") == y).orderBy(order, "k1", "k2", "word_no", "run_no").limit(bound) for y in (0, 1)]
    rows = save(part[0].union(part[1]).select("label", "features"), "labelled-findings")
    if len(rows.select("label").distinct().limit(2).collect()) < 2:
        return None
    return RandomForestClassifier(labelCol="label", featuresCol="features", numTrees=TREES,
                                  maxDepth=DEPTH, seed=SEED).fit(rows.coalesce(1))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path_col: str | None = "source",
         labels=weak_labels) -> DataFrame:
    """Every candidate with its probability: id, word_no (its place among the
    words), run_no (its place among the word's runs, from 0), candidate, the numeric features, probability, is_secret.

    ``labels`` maps findings to their label column (null: not labelled); the
    findings of :func:`never_labelled` candidates are not learned from.  A null
    or empty text has no candidate; a null id or path is a value like any other;
    rows equal in id, text and path give one result; several candidates of a
    text, also equal ones, are results of their own; if the labels have one
    class only, every probability is null and every candidate stays a secret;
    an empty table gives an empty result.  Only the named columns are read.
    """
    found = save(candidates(docs, id_col, text_col, path_col).distinct(), "candidates")
    words = dictionary(docs, text_col)
    label = F.when(~never_labelled(F.col("candidate")), labels(found))
    rows = save(features(found, words).withColumn("label", label), "findings")
    model = train(rows.where(F.col("label").isNotNull()))
    if model is None:
        scored = rows.withColumn("probability", F.lit(None).cast("double"))
    else:
        scored = model.setProbabilityCol("__p").setPredictionCol("").setRawPredictionCol("").transform(
            rows).withColumn("probability", vector_to_array("__p")[1])
    keep = F.coalesce(F.col("probability") >= THRESHOLD, F.lit(True))
    return scored.select(F.col("id").alias(id_col), "word_no", "run_no", "candidate", *NUMBERS, "label",
                         "probability", keep.alias("is_secret"))
