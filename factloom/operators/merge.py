"""Merge of an observation log: all rows of an id fold into one, in sequence order, conflicts kept.

Every rule is a mergeable aggregate, so Spark combines it before the shuffle and an id with very many
observations never has to sit in one task's memory as a list.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def first_known(column: str, order: list[str]) -> Column:
    """The first non-null value in sequence order (fill rule)."""
    return F.min_by(column, F.when(F.col(column).isNotNull(), F.struct(*order)))


def last_known(column: str, order: list[str]) -> Column:
    return F.max_by(column, F.when(F.col(column).isNotNull(), F.struct(*order)))


def contradicts(column: str) -> Column:
    """Whether the known values differ: cheaper than counting distinct ones."""
    return F.coalesce(F.min(column) != F.max(column), F.lit(False))


def merge_observations(df: DataFrame, ids: list[str], order: list[str], rules: dict[str, str]) -> DataFrame:
    """One row for each id. rules: column to first | last | min | max | sum | union | count.

    Columns under "first" also get <column>_conflict, and conflicts lists the contradicted names.
    """
    make = {
        "first": lambda c: first_known(c, order),
        "last": lambda c: last_known(c, order),
        "min": F.min,
        "max": F.max,
        "sum": F.sum,
        "count": F.count,
        "union": lambda c: F.array_join(F.array_sort(F.collect_set(F.col(c).cast("string"))), ","),
    }
    kept = [make[rule](c).alias(c) for c, rule in rules.items()]
    clashes = [contradicts(c).alias(f"{c}_conflict") for c, rule in rules.items() if rule == "first"]
    out = df.groupBy(*ids).agg(F.count("*").alias("observations"), *kept, *clashes)
    names = [F.when(F.col(f"{c}_conflict"), F.lit(c)) for c, rule in rules.items() if rule == "first"]
    return out.withColumn("conflicts", F.concat_ws(",", *names)) if names else out


def last_writer(df: DataFrame, ids: list[str], order: list[str], columns: list[str]) -> DataFrame:
    return df.groupBy(*ids).agg(F.max_by(F.struct(*columns), F.struct(*order)).alias("r")).select(*ids, "r.*")


def first_writer(df: DataFrame, ids: list[str], order: list[str], columns: list[str]) -> DataFrame:
    return df.groupBy(*ids).agg(F.min_by(F.struct(*columns), F.struct(*order)).alias("r")).select(*ids, "r.*")


def sticky(df: DataFrame, ids: list[str], order: list[str], terminal: Column, columns: list[str]) -> DataFrame:
    """The latest terminal row, else the latest row: a decided state survives later pending ones."""
    rank = F.struct(terminal.cast("int").alias("terminal"), *order)
    return df.groupBy(*ids).agg(F.max_by(F.struct(*columns), rank).alias("r")).select(*ids, "r.*")


def conflict_report(df: DataFrame, ids: list[str], columns: list[str]) -> DataFrame:
    """A row for each id and contradicted column: how many values, and the least and greatest.

    Each column's distinct values are found and counted by themselves: narrow rows, combined before both shuffles.
    """

    def of(c: str) -> DataFrame:
        values = df.select(*ids, c).where(F.col(c).isNotNull()).distinct()
        found = values.groupBy(*ids).agg(F.count("*").alias("n_values"), F.min(c).alias("low"), F.max(c).alias("high")).where("n_values > 1")
        return found.select(*ids, F.lit(c).alias("field"), "n_values", F.col("low").cast("string").alias("low"), F.col("high").cast("string").alias("high"))

    return reduce(DataFrame.unionByName, map(of, columns))


def fold_in_order(df: DataFrame, ids: list[str], order: list[str], value: str, evidence: str) -> DataFrame:
    """The exact order-dependent fold: a row that contradicts the held value gives its evidence only.

    Returns value (the first known), evidence (sorted union, joined) and dropped (contradicting rows). Rows are
    counted by value and the counts folded by id, so no row meets its id's result again.
    """
    known = F.col(value).isNotNull()
    by_value = df.groupBy(*ids, value).agg(F.min(F.struct(*order)).alias("at"), F.count("*").alias("n"), F.collect_set(F.col(evidence).cast("string")).alias("e"))
    own = F.min_by(F.struct(value, "n"), F.when(known, F.col("at"))).alias("own")
    by_id = by_value.groupBy(*ids).agg(own, F.sum(F.when(known, F.col("n"))).alias("all"), F.collect_list("e").alias("e"))
    return by_id.select(*ids, F.col("own")[value].alias(value), F.array_join(F.array_sort(F.array_distinct(F.flatten("e"))), ",").alias("evidence"), F.coalesce(F.col("all") - F.col("own.n"), F.lit(0)).alias("dropped"))


def walk(df: DataFrame, name: str, ids: list[str]) -> DataFrame:
    """rows, distinct ids and repeats of a table."""
    return df.agg(F.count("*").alias("n_rows"), F.count_distinct(*ids).alias("n_ids")).select(F.lit(name).alias("table_name"), "n_rows", "n_ids", (F.col("n_rows") - F.col("n_ids")).alias("repeats"))
