"""Best value for each comparison key, with tie rules, tied ids and contested contexts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def rank_of(value: str, larger: bool | Column, date: str, ids: list[str]) -> Column:
    """A struct whose least is the winner: better value, then earlier known date, then smaller id."""
    v = F.when(larger, -F.col(value)).otherwise(F.col(value)) if isinstance(larger, Column) else (-F.col(value) if larger else F.col(value))
    return F.struct(v.alias("v"), F.col(date).isNull().alias("undated"), F.col(date).alias("d"), *ids)


def best_per_key(df: DataFrame, key: list[str], value: str, larger: bool, date: str, ids: list[str], keep: list[str]) -> DataFrame:
    """One winner a key. min_by of a struct combines before the shuffle; no window, no sort of groups."""
    return df.groupBy(*key).agg(F.min_by(F.struct(value, date, *ids, *keep), rank_of(value, larger, date, ids)).alias("w"), F.count("*").alias("candidates")).select(*key, "w.*", "candidates")


def tied_ids(df: DataFrame, key: list[str], value: str, larger: bool, id_col: str) -> DataFrame:
    """A row for each key and id that has the winning value: key, best, id. No list of ties is gathered."""
    seen = df.where(F.col(value).isNotNull()).groupBy(*key, id_col).agg((F.max if larger else F.min)(value).alias("best"))
    best = seen.groupBy(*key).agg((F.max if larger else F.min)("best").alias("best"))
    return seen.join(best, [*key, "best"]).select(*key, "best", id_col)


def split_contested(df: DataFrame, key: list[str], context: list[str], value: str) -> tuple[DataFrame, DataFrame]:
    """(rows of settled contexts, contested contexts): a context with two observed values has no candidate."""
    seen = df.groupBy(*key, *context).agg(F.min(value).alias("low"), F.max(value).alias("high"), F.count("*").alias("n"))
    return seen.where(F.col("low") == F.col("high")).withColumnRenamed("low", value).drop("high"), seen.where(F.col("low") != F.col("high"))
