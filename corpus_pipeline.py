"""A corpus on its way to training: judged, deduplicated, cleaned of benchmarks and secrets, and packed."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from salesloom.llm import decontaminate, near_dedup, packing, quality_rules, secret_scan
from salesloom.session import fresh_folder


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go; lines that a host repeats everywhere go from the others."""
    return quality_rules.apply_quality(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates (five words, similarity 0.8) the smallest id stays."""
    return near_dedup.without_near_duplicates(docs)


def benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go."""
    return decontaminate.without_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by a mark."""
    return secret_scan.redact_secrets(docs)


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per piece of a document: the sequence that it goes to, and its place there."""
    return packing.pack_documents(docs)


STAGES = [
    ("quality_rules", quality),
    ("near_dedup", near_duplicates),
    ("decontamination", benchmarks),
    ("secret_scan", secrets),
    ("packing", sequences),
]

#: Near-duplicates and packing cannot be said in SQL; tests/llm holds the brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each one's rows are written and read again for the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        folder = fresh_folder(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(folder)
        docs = spark.read.parquet(folder)
    return docs
