"""Registered queries of the training-data operators: thin wrappers with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (decontam, html_extract, kneser_ney, lang_id, line_dedup, mixing, near_dup, prefix_trie, quality_model,
               quality_rules, resampling, toxicity, url_filter)
from .tables import table


#: Host and path rules that op1 applies before its model.
URL_RULES = [("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/")]


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(table(spark, sf_dir, "pages"), URL_RULES)


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lang_id.identify(table(spark, sf_dir, "documents"))


def op3_weighted_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_rules(table(spark, sf_dir, "documents"))


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup.dedup_lines(docs).select(
        "doc_id", "text", F.col("__n_lines").alias("n_lines"), F.col("__n_removed").alias("n_removed"))


def op6_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.near_duplicates(table(spark, sf_dir, "documents"), shingle=3, percent=85, half=3, collections=12)


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_quality_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_model.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.main_text(table(spark, sf_dir, "pages"))


def op10_decontam(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampling.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.branched_trie(table(spark, sf_dir, "conversations"))


def op13_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = kneser_ney.score(table(spark, sf_dir, "documents"), order=2)
    return scored.withColumns({c: F.round(c, 6) for c in ("base_score", "score")})


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline  # sits beside the driver entry; imported here because it imports this package

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict:
    named = [op1_url_filter, op2_language_id, op3_weighted_mix, op4_quality_rules, op5_line_dedup, op6_near_dup, op7_toxicity,
             op8_quality_model, op9_html_text, op10_decontam, op11_importance_resampling, op12_prefix_trie, op13_lm_score, pipeline]
    return {f.__name__: f for f in named}


def oracle_sql() -> dict:
    return {"op4_quality_rules": quality_rules.ORACLE_SQL, "op11_importance_resampling": resampling.ORACLE_SQL,
            "op12_prefix_trie": prefix_trie.ORACLE_SQL, "op13_lm_score": kneser_ney.ORACLE_SQL}
