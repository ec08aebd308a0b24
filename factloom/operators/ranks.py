"""Positions within groups of any size, without gathering a group in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from factloom.operators.durable import cut


def numbered(df: DataFrame, group: list[str], order: list[str]) -> DataFrame:
    """df with rank, from 1, of each row in its group's order.

    Rows are range-partitioned by group and order, so a large group lies in several ranges; a row's rank is the
    number of its group's rows in earlier ranges and its place in its own.
    """
    rows = cut(df.repartitionByRange(*group, *order).withColumn("__range", F.spark_partition_id()), "ranges")
    counts = rows.groupBy(*group, "__range").agg(F.count("*").alias("__n"))
    before = F.sum("__n").over(W.partitionBy(*(group or [F.lit(0)])).orderBy("__range").rowsBetween(W.unboundedPreceding, -1))
    starts = counts.select(*[F.col(g).alias(f"__{g}") for g in group], F.col("__range").alias("__at"), F.coalesce(before, F.lit(0)).alias("__start"))
    same = F.col("__range") == F.col("__at")
    for g in group:
        same = same & F.col(g).eqNullSafe(F.col(f"__{g}"))
    here = F.row_number().over(W.partitionBy(*group, "__range").orderBy(*order))
    return rows.withColumn("__here", here).join(starts, same).withColumn("rank", F.col("__start") + F.col("__here")).select(*df.columns, "rank")
