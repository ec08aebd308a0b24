"""Explicit schemas of the test tables and their reader; nothing is inferred."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

NAMES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One table; Parquet carries its schema, so only the columns a query names are read."""
    if name not in NAMES:
        raise ValueError(f"no such table: {name}")
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def day(column: str):
    """A timestamp's calendar day as ISO text, the same in any engine."""
    return F.date_format(F.col(column), "yyyy-MM-dd")


def money(column: str):
    """A double with two decimals as an exact decimal, so that sums don't depend on their order."""
    return F.col(column).cast("decimal(18,2)")


def register(spark: SparkSession, sf_dir: str) -> None:
    """All tables as temporary views, for spark.sql."""
    for name in NAMES:
        load(spark, sf_dir, name).createOrReplaceTempView(name)
