"""A training corpus from ``documents``: quality rules, line de-duplication,
near-duplicate removal, benchmark decontamination, packing.

Each stage is ``(spark, docs, sf_dir) -> DataFrame`` and works on all that its
predecessor kept; ``run`` writes what a stage returns to shared storage and
gives it, read again, to the next.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tripwright.llm import decontam, lines, packing, quality, simhash
from tripwright.llm.common import drop, read, save, worker_path
from tripwright.llm.queries import vocabulary


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rule or a learned rule rejects go."""
    worker_path(spark)
    return quality.keep_good(docs, quality.train(docs, read(spark, sf_dir, "labels")))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later repeated runs of lines go from the texts; all documents stay, one
    that was a copy as a whole with an empty text."""
    from pyspark.sql import functions as F
    out = lines.delete_lines(docs)
    return out.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else out


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component stays: the smallest doc_id."""
    worker_path(spark)
    return simhash.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that overlap a benchmark item go."""
    return decontam.clean(docs, read(spark, sf_dir, "benchmark"))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all remaining documents with their place in a sequence."""
    worker_path(spark)
    return packing.pack_documents(docs, vocabulary(), added=True)


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("simhash_near_dedup", near_duplicates),
    ("benchmark_decontamination", decontamination),
    ("best_fit_packing", best_fit_packing),
]

# A learned list, SimHash and a tokenizer are not SQL; tests compare the
# pipeline with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        kept = save(stage(spark, docs, sf_dir), name)
        drop(docs)                   # what the stage before wrote has been read
        docs = kept
    return docs
