"""The dealt operators as queries over whole tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import (codes, decontam, html_text, interaction, langid, lines, packing, pii, quality,
               secrets, simhash, suffix, tokencount)
from .common import read, worker_path

Query = Callable[[SparkSession, str], DataFrame]


def vocabulary() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


def pieces_vocabulary() -> str:
    import public_tokenizers
    return public_tokenizers.path("piece_bpe_32k.model")


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(read(spark, sf_dir, "documents"))


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.overlaps(read(spark, sf_dir, "documents"),
                             read(spark, sf_dir, "benchmark")).drop("k1", "k2")


def op3_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    worker_path(spark)
    return html_text.extract(read(spark, sf_dir, "pages"))


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    worker_path(spark)
    return simhash.near_duplicates(read(spark, sf_dir, "documents"))


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    worker_path(spark)
    return packing.pack_documents(read(spark, sf_dir, "documents"), vocabulary(), added=True)


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    worker_path(spark)
    docs = read(spark, sf_dir, "documents")
    return quality.judge(docs, quality.train(docs, read(spark, sf_dir, "labels")))


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    worker_path(spark)
    return suffix.remove_repeats(read(spark, sf_dir, "documents"))


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.line_report(read(spark, sf_dir, "documents"))


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    worker_path(spark)
    return tokencount.token_counts(read(spark, sf_dir, "documents"), pieces_vocabulary())


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    worker_path(spark)
    return langid.identify(read(spark, sf_dir, "documents"))


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    worker_path(spark)
    return codes.compress(read(spark, sf_dir, "embeddings"))


def op12_filter_interactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    worker_path(spark)
    return interaction.interactions(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op13_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    worker_path(spark)
    return pii.personal_data(read(spark, sf_dir, "documents"))


QUERIES: dict[str, Query] = {f.__name__: f for f in (
    op1_secret_scan, op2_decontamination, op3_html_extraction, op4_simhash, op5_packing,
    op6_quality_rules, op7_suffix_dedup, op8_line_dedup, op9_token_counts, op10_language_id,
    op11_vector_codes, op12_filter_interactions, op13_personal_data)}

ORACLE_SQL = {
    "op2_decontamination": decontam.OVERLAPS_SQL,
    "op8_line_dedup": lines.LINE_REPORT_SQL,
    "op11_vector_codes": codes.COMPRESS_SQL,
    "op12_filter_interactions": interaction.INTERACTIONS_SQL,
}
