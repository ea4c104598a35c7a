"""The registered queries of this subpackage, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from rollcall.llm import decontaminate, hard_negatives, language_id, packing, page_wrappers, quality_ftrl, quality_rules, secrets_crf, simhash, substring_dedup, token_alignment, toxicity_knn, url_filter
from rollcall.llm.common import table


def op1_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets_crf.query(table(spark, sf_dir, "documents"))


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_ftrl.query(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.query(table(spark, sf_dir, "documents"))


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.query(table(spark, sf_dir, "documents"))


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.query(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.query(table(spark, sf_dir, "documents"))


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.query(table(spark, sf_dir, "documents"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity_knn.query(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.query(table(spark, sf_dir, "pages"))


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.query(table(spark, sf_dir, "documents"))


def op11_page_wrappers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return page_wrappers.query(table(spark, sf_dir, "pages"))


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_alignment.query(table(spark, sf_dir, "documents"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives.query(table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_secrets": op1_secrets,
    "op2_quality": op2_quality,
    "op3_substring_dedup": op3_substring_dedup,
    "op4_language_id": op4_language_id,
    "op5_decontaminate": op5_decontaminate,
    "op6_packing": op6_packing,
    "op7_quality_rules": op7_quality_rules,
    "op8_toxicity": op8_toxicity,
    "op9_urls": op9_urls,
    "op10_simhash": op10_simhash,
    "op11_page_wrappers": op11_page_wrappers,
    "op12_token_alignment": op12_token_alignment,
    "op13_hard_negatives": op13_hard_negatives,
}

ORACLE_SQL: dict[str, str] = {
    "op3_substring_dedup": substring_dedup.SQL,
    "op5_decontaminate": decontaminate.SQL,
    "op13_hard_negatives": hard_negatives.SQL,
}
