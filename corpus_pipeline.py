"""Corpus preparation in stages.  Each stage takes (spark, docs, sf_dir) and returns a DataFrame.

All stages take null ids and texts, empty and very long texts, ties and repeated rows, an empty table and further columns, also
such whose names a stage uses itself.  All but the last keep every column of what they are given.  Their executors and Python workers
serve one stage after the other, so each stage bounds the batches that they hold.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lifeloom.llm import decontaminate, lattice, quality, secrets, simhash
from lifeloom.llm.common import settled, table
from lifeloom.session import configure, small_batches


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go.  A null or empty text is scored like any other; repeated rows share a fate."""
    small_batches(spark)
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays: the text with the smallest id.  Rows without an id stay, and so do repeated rows of
    the text that stays."""
    small_batches(spark)
    return simhash.keep_one(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item, exactly or nearly, go.  Texts without words stay."""
    small_batches(spark)
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def secret_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets in the texts are masked; every row stays, null texts stay null."""
    small_batches(spark)
    return secrets.redacted(docs)


def tokenize_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digest of every text, one row per row; null and empty texts have no tokens."""
    small_batches(spark)
    return lattice.report(docs)


STAGES = [
    ("quality_classifier", quality_stage),
    ("simhash_near_dedup", near_dedup_stage),
    ("benchmark_decontamination", decontamination_stage),
    ("secret_scan", secret_stage),
    ("sentencepiece", tokenize_stage),
]

#: No SQL: a trained classifier is part of it.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to ``documents``; each stage's rows are written as Parquet and read again by the next.

    An empty table gives an empty result.
    """
    configure(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = settled(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
