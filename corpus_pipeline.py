"""A corpus pipeline: quality rules, near duplicates, benchmark passages, secrets, tokens.

Each stage takes ``(spark, docs, sf_dir)`` and works on all rows that the one before kept; its
result is written as Parquet in the shared scratch folder and read again as the next one's input.
Stages keep the columns of ``documents``; the last returns token counts and digests by document.

Defined cases: null and empty texts fail the quality rules and go. Rows that repeat id and text stay
once. Rows are named by id and text, so rows of one id or of none are each decided on by their own
text. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from meterline.llm import bpe, decontam, jaccard, quality, secret_scan
from meterline.llm.textops import table, write_table
from meterline.session import scratch_path


def tuned(spark: SparkSession) -> SparkSession:
    """The session setting this application runs with: small Arrow batches, as rows carry whole texts."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    return spark


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the fixed rules and the log-likelihood ratio keep."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of similar ones, that of the smallest id."""
    tuned(spark)
    return jaccard.keep_first(docs)


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that overlap no benchmark item."""
    tuned(spark)
    return decontam.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets in their texts replaced by a mark."""
    tuned(spark)
    return secret_scan.redact(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token count and digests of tokens and decoded text."""
    tuned(spark)
    return bpe.encode_digests(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("benchmark_passages", benchmark_passages),
    ("secrets", secrets),
    ("tokens", tokens),
]

#: SQL can't express the hashed log-likelihood ratio nor the tokens; tests/llm has the brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = write_table(stage(spark, docs, sf_dir), scratch_path(spark, f"pipeline-{name}"))
    return docs
