"""Budgets that refuse, never truncate."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def within_rows(df: DataFrame, most: int) -> DataFrame:
    """df, or an error in the job that reads it if it has more rows: counted by combined partial sums."""
    n = df.agg(F.count("*")).scalar()
    return df.where(F.assert_true(n <= most, F.lit(f"more than {most} rows")).isNull())


def read_counts(df: DataFrame, scope: list[str], raw: str, ids: list[str], most_rows: int, most_bytes: int) -> DataFrame:
    """Per scope: n_rows, bytes (of the encoded rows), merged_rows (distinct ids) and whether rows and bytes fit the budget.

    One pass that combines before the shuffle; a scope that doesn't fit is told, never cut.
    """
    per_id = df.groupBy(*scope, *ids).agg(F.count("*").alias("n"), F.sum(F.octet_length(raw)).alias("b"))
    out = per_id.groupBy(*scope).agg(F.sum("n").alias("n_rows"), F.sum("b").alias("bytes"), F.count("*").alias("merged_rows"))
    return out.withColumn("fits", (F.col("n_rows") <= most_rows) & (F.col("bytes") <= most_bytes))


def refuse_groups(df: DataFrame, key: list[str], most: int) -> tuple[DataFrame, DataFrame]:
    """(rows of groups within the budget, refused keys with their sizes): a group is refused whole."""
    sizes = df.groupBy(*key).agg(F.count("*").alias("size"))
    refused = sizes.where(F.col("size") > most)
    return df.join(refused.select(*key), key, "left_anti"), refused


def monotone(df: DataFrame, stages: list[str]) -> DataFrame:
    """df with a column telling whether each stage's counter is at most the one before."""
    ok = F.lit(True)
    for a, b in zip(stages, stages[1:], strict=False):
        ok = ok & (F.col(a) >= F.col(b))
    return df.withColumn("monotone", ok)
