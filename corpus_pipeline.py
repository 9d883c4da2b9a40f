"""A training-corpus pipeline: each stage calls one operator of `plumeline.llm`."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from plumeline.llm import decontam, pieces, quality, secrets, simhash
from plumeline.llm.text import written

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that fail a hard rule or come from a rejected host."""
    return quality.keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the document with the smallest id of each group of SimHash neighbours (four-word shingles, four bits)."""
    return simhash.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold a window of a benchmark item."""
    return decontam.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Mask secrets in the texts; every document stays."""
    return secrets.redact(docs).withColumn("n_chars", F.length("text").cast("bigint"))


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Encode the texts: piece counts, digests, scores of the four best segmentations."""
    return pieces.segment(docs, {c: docs[c] for c in ("doc_id", "lang", "source", "n_chars")})


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("secret_scan", secret_scan),
    ("tokenize", tokenize),
]

# N-best segmentation is a search; tests compare the stages with brute force instead.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``, each written before the next reads it."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
