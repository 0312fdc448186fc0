"""The corpus pipeline: quality, near-duplicates, benchmark passages, personal data, mix."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from caseflow.llm import decontaminate, mixing, pii, quality, simhash
from caseflow.session import materialise

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail a base rule or come from a rejected source go."""
    return quality.keep_good(docs)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of near-duplicates stays: the smallest id's."""
    return simhash.drop_near_copies(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words of benchmark passages are cut; a document with no word left goes."""
    return decontaminate.remove_benchmark(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal values become pseudonyms of the same format."""
    return pii.hide_personal_data(docs, pii.EXAMPLE_KEY)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it."""
    return mixing.mixed_documents(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", good_documents),
    ("simhash_near_dedup", without_near_copies),
    ("benchmark_decontamination", without_benchmark),
    ("pii", without_personal_data),
    ("mix_sources", mixed),
]

# SimHash and pseudonyms are beyond SQL; tests compare the run with a brute-force version.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written and read again as the next one's input."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return docs
