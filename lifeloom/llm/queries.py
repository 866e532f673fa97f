"""The registered queries of this folder: thin, production parameters, whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..session import configure
from . import decontaminate, imatch, lattice, licences, lines, periods, pii, quality, secrets, simhash, suffixes, tries, urls
from .common import table


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence phrases and templates of every document."""
    configure(spark)
    return licences.report(table(spark, sf_dir, "documents"))


def op2_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark words in every document, and the items that it holds nearly."""
    configure(spark)
    return decontaminate.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op3_i_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint of every document and of its edited text."""
    configure(spark)
    return imatch.report(table(spark, sf_dir, "documents"))


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document, plain and disguised."""
    configure(spark)
    return pii.report(table(spark, sf_dir, "documents"))


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every secret candidate of every document with its score."""
    configure(spark)
    return secrets.report(table(spark, sf_dir, "documents"))


def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document."""
    configure(spark)
    return quality.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate component of every document."""
    configure(spark)
    return simhash.groups(table(spark, sf_dir, "documents"), width=3)


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rule and verdict of every page."""
    configure(spark)
    return urls.verdicts(table(spark, sf_dir, "pages"))


def op9_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What stays of every document without its repeated strings."""
    configure(spark)
    return suffixes.report(table(spark, sf_dir, "documents"))


def op10_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts, digest and round trip of every document."""
    configure(spark)
    return lattice.report(table(spark, sf_dir, "documents"))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nodes of the conversations' prefix trie with members, leaves and savings."""
    configure(spark)
    return tries.report(table(spark, sf_dir, "conversations"))


def op12_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What stays of every document without lines that other documents hold."""
    configure(spark)
    return lines.report(table(spark, sf_dir, "documents"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of every document's words, and its words without repetitions."""
    configure(spark)
    return periods.report(table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (
    op1_license_scan, op2_benchmark_decontamination, op3_i_match, op4_pii, op5_secret_scan, op6_quality_classifier, op7_url_filter,
    op8_simhash_near_dedup, op9_suffix_array_dedup, op10_sentencepiece, op11_prefix_trie, op12_line_dedup, op13_periodic_runs,
)}
ORACLES = {
    "op2_benchmark_decontamination": decontaminate.ORACLE,
    "op9_suffix_array_dedup": suffixes.ORACLE,
    "op11_prefix_trie": tries.ORACLE,
    "op12_line_dedup": lines.ORACLE,
}
