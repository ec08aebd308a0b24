"""The corpus pipeline: quality, near-dedup, secrets, mixing, packing; each stage works on what its predecessor kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from factloom.llm import mixing, neardup, packing, quality, secrets
from factloom.llm.common import cut, table
from factloom.llm.queries import tokenizer_path


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    return quality.keep_quality(docs, table(spark, sf_dir, "labels"))


def neardup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays (five-word shingles, likeness 0.8)."""
    return neardup.dedup(docs)


def secrets_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Live secrets are replaced in the texts; every document stays."""
    return secrets.redact(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources reach their target weights: a row for each time the mixture takes a document."""
    return mixing.mixture(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every piece's place in the training sequences."""
    return packing.pack(docs, tokenizer_path())


STAGES = [
    ("quality", quality_stage),
    ("near-dedup", neardup_stage),
    ("secrets", secrets_stage),
    ("mixing", mixing_stage),
    ("packing", packing_stage),
]

#: SQL has neither the classifier nor the tokenizer; the tests compare with brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = cut(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
