"""The queries of this package by name, and their SQL counterparts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from salesloom.llm import decontaminate, language_model, license_scan, near_dedup, packing, parity_join, periodic_runs, quality_rules, secret_scan, sharding, sql, substring_dedup, token_alignment, url_filter


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.secret_report(_table(spark, sf_dir, "documents"))


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.license_report(_table(spark, sf_dir, "documents"))


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.repeats_report(_table(spark, sf_dir, "documents"))


def op4_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    like = near_dedup.Likeness(words=3, percent=85)
    return near_dedup.near_duplicates(_table(spark, sf_dir, "documents"), like)


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.sharding_report(_table(spark, sf_dir, "documents"))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_report(_table(spark, sf_dir, "documents"))


def op7_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_model.score_texts(_table(spark, sf_dir, "documents"))


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages")
    return url_filter.judge_urls(pages, url_filter.rules_table(spark))


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leak_report(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(_table(spark, sf_dir, "documents"))


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_alignment.align_tokens(_table(spark, sf_dir, "documents"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs.runs_report(_table(spark, sf_dir, "documents"))


def op13_parity_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parity_join.jaccard_join(_table(spark, sf_dir, "documents"))


def queries():
    return {
        "op1_secret_scan": op1_secret_scan,
        "op2_license_scan": op2_license_scan,
        "op3_substring_dedup": op3_substring_dedup,
        "op4_near_dedup": op4_near_dedup,
        "op5_sharding": op5_sharding,
        "op6_quality_rules": op6_quality_rules,
        "op7_language_model": op7_language_model,
        "op8_url_filter": op8_url_filter,
        "op9_decontamination": op9_decontamination,
        "op10_packing": op10_packing,
        "op11_token_alignment": op11_token_alignment,
        "op12_periodic_runs": op12_periodic_runs,
        "op13_parity_join": op13_parity_join,
    }


def oracle_sql() -> dict[str, str]:
    return sql.ORACLE
