"""The registered queries of this package: thin digests of its operators over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontaminate, hpylm, html_main, line_quality, merkle, mixing, near_dup, ngram_join, phrases, pii, rule_quality, secrets, toxicity
from ._base import table

Query = Callable[[SparkSession, str], DataFrame]


def op1_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hpylm.score_documents(table(spark, sf_dir, "documents"))


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sources(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op3_line_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_quality.line_frequency_filter(table(spark, sf_dir, "documents"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.near_duplicates(table(spark, sf_dir, "documents"), shingle=4)


def op6_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan_secrets(table(spark, sf_dir, "documents"))


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find_pii(table(spark, sf_dir, "documents"))


def op8_html_main(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_main.extract_pages(table(spark, sf_dir, "pages"))


def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op10_rule_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rule_quality.quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.similar_sets(table(spark, sf_dir, "documents"), shingle=4, percent=85)


def op12_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"))


def op13_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.digest_rows(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Query]:
    return {f.__name__: f for f in (op1_lm_score, op2_mixing, op3_line_quality, op4_toxicity, op5_near_dup, op6_secrets, op7_pii, op8_html_main, op9_decontaminate, op10_rule_quality, op11_ngram_join, op12_phrases, op13_merkle)}


def oracle_sql() -> dict[str, str]:
    return {"op2_mixing": mixing.ORACLE, "op11_ngram_join": ngram_join.ORACLE, "op12_phrases": phrases.ORACLE, "op13_merkle": merkle.ORACLE}
