"""Joins with outcomes, scopes and diffs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType


def split_scope(df: DataFrame, inside: Column) -> tuple[DataFrame, DataFrame]:
    """(rows in scope, the retained complement); a row whose predicate is null is outside."""
    known = F.coalesce(inside, F.lit(False))
    return df.where(known), df.where(~known)


def unique_match(left: DataFrame, right: DataFrame, on: list[str], right_id: str) -> DataFrame:
    """left with the match only if the key names one right row: outcome unique, ambiguous or absent.

    The right side is aggregated by key first, so no left row is ever multiplied.
    """
    index = right.groupBy(*on).agg(F.count_distinct(right_id).alias("matches"), F.min(right_id).alias("match"))
    outcome = F.when(F.col("matches").isNull(), "absent").when(F.col("matches") > 1, "ambiguous").otherwise("unique")
    return left.join(index, on, "left").withColumn("outcome", outcome).withColumn("match", F.when(F.col("matches") == 1, F.col("match"))).drop("matches")


def snapshot_diff(before: DataFrame, after: DataFrame, keys: list[str], fields: list[str]) -> DataFrame:
    """change is added, removed or modified; changed lists the fields that differ, null-safely."""
    old = before.select(*keys, F.struct(*fields).alias("old"))
    new = after.select(*keys, F.struct(*fields).alias("new"))
    names = [F.when(~F.col("old")[f].eqNullSafe(F.col("new")[f]), F.lit(f)) for f in fields]
    change = F.when(F.col("old").isNull(), "added").when(F.col("new").isNull(), "removed").otherwise("modified")
    out = old.join(new, keys, "full_outer").withColumn("change", change).withColumn("changed", F.when(F.col("change") == "modified", F.concat_ws(",", *names)).otherwise(F.lit("")))
    return out.where((F.col("change") != "modified") | (F.col("changed") != "")).select(*keys, "change", "changed")


def interval_join(facts: DataFrame, windows: DataFrame, on: list[str], at: str, first: str, last: str) -> DataFrame:
    """Facts in the windows of their key that hold them, both ends inclusive: an equi-join, then a range."""
    return facts.join(windows, on).where(F.col(at).between(F.col(first), F.col(last)))


def as_of(facts: DataFrame, versions: DataFrame, on: list[str], at: str, since: str, columns: list[str]) -> DataFrame:
    """Each fact with the latest version of its key not after it (null if none), without a range join.

    Both sides meet in one sorted stream: a running last value by key carries versions to facts.
    """
    from pyspark.sql import Window as W

    shape = F.struct(F.col(since).alias("since"), *columns)
    left = facts.select(*on, F.col(at).alias("__at"), F.lit(1).alias("__kind"), F.struct(*facts.columns).alias("__row"), F.lit(None).cast(versions.select(shape.alias("s")).schema["s"].dataType).alias("__v"))
    right = versions.select(*on, F.col(since).alias("__at"), F.lit(0).alias("__kind"), F.lit(None).cast(left.schema["__row"].dataType).alias("__row"), shape.alias("__v"))
    run = W.partitionBy(*on).orderBy("__at", "__kind").rowsBetween(W.unboundedPreceding, W.currentRow)
    out = left.unionByName(right).withColumn("__v", F.last("__v", ignorenulls=True).over(run)).where("__kind = 1")
    return out.select("__row.*", *[F.col("__v")[c].alias(c) for c in columns])


def pair_agreements(df: DataFrame, keys: list[str], id_col: str, same: dict[str, str], tile: int = 4096) -> DataFrame:
    """All pairs of rows with equal keys, a the smaller numeric id and b the larger, and by name whether a column agrees in both.

    A group's rows in the ids' order are cut into lists of that many, and a row walks the lists that may hold larger
    ids. A quarter of a list's length of rows meets one list at a time, so that a group of any size lies in many tasks.
    Only the numbering of a group's rows is one sorted stream.
    """
    from pyspark.sql import Window as W

    spark, group = df.sparkSession, W.partitionBy(*keys)
    # pairs are the work, not the bytes by which adaptive execution would merge partitions: it leaves a given number alone
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 8 * spark.sparkContext.defaultParallelism)
    known = df.where(F.expr(" and ".join(f"`{c}` is not null" for c in [*keys, id_col]))).repartition(parts, *keys)
    ident = F.coalesce(F.col(id_col), F.lit(0).cast(df.schema[id_col].dataType))  # never null, which Parquet writes faster
    # texts are compared once a row, as ranks in their group
    value = lambda c: F.when(F.col(c).isNotNull(), F.dense_rank().over(group.orderBy(c))) if isinstance(df.schema[c].dataType, StringType) else F.col(c)
    rows = known.select(*keys, ident.alias("a"), *[value(c).alias(f"x_{n}") for n, c in same.items()])
    placed = rows.withColumn("at", (F.row_number().over(group.orderBy("a")) - 1).cast("long")).withColumn("j", F.expr(f"at div {tile}"))
    share = F.expr(f"at div {max(1, tile // 4)}")
    left = placed.withColumn("last", F.max("j").over(group)).select(*keys, share.alias("i"), F.explode(F.sequence("j", "last")).alias("j"), "a", *[f"x_{n}" for n in same])
    listed = F.sort_array(F.collect_list(F.struct(F.col("a").alias("b"), *[F.col(f"x_{n}").alias(f"y_{n}") for n in same])))
    lists = placed.groupBy(*keys, "j").agg(F.max(share).alias("i"), listed.alias("ys")).select(*keys, F.explode(F.sequence(F.lit(0).cast("long"), "i")).alias("i"), "j", "ys")
    met = left.repartition(parts, *keys, "i", "j").join(lists.repartition(parts, *keys, "i", "j"), [*keys, "i", "j"])
    pairs = met.select("a", *[f"x_{n}" for n in same], F.inline("ys")).where("a < b")
    return pairs.select("a", "b", *[(F.col(f"x_{n}") == F.col(f"y_{n}")).alias(n) for n in same])


def multiset_diff(expected: DataFrame, found: DataFrame, keys: list[str]) -> DataFrame:
    """Keys whose numbers of rows differ: missing and excess."""
    signed = expected.select(*keys, F.lit(1).alias("n")).unionByName(found.select(*keys, F.lit(-1).alias("n")))
    out = signed.groupBy(*keys).agg(F.sum("n").alias("n")).where("n <> 0")
    return out.select(*keys, F.greatest("n", F.lit(0)).alias("missing"), F.greatest(-F.col("n"), F.lit(0)).alias("excess"))
