"""Event-sourced identities: binds, merges, splits and revokes replayed to redirects; dated memberships."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factloom.operators.resolve import components


def replay(decisions: DataFrame) -> DataFrame:
    """(id, canonical) after all decisions (seq, kind, a, b), kind merge, split or revoke.

    Of the decisions on one pair the last counts: a merge stands unless a later split or revoke undoes
    it. Standing merges form components whose least (oldest) id is canonical.
    """
    pair = [F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")]
    last = decisions.select("seq", "kind", *pair).groupBy("a", "b").agg(F.max_by("kind", "seq").alias("kind"))
    return components(last.where("kind = 'merge'").select("a", "b")).select(F.col("v").alias("id"), F.col("label").alias("canonical"))


def membership(subjects: DataFrame, assertions: DataFrame, on: str, at: str) -> DataFrame:
    """verdict of dated include and exclude assertions (first, last, include) for each subject at its day.

    An exclude that holds wins over includes; none that holds is unknown.
    """
    held = subjects.join(assertions, on).where(F.col(at).between(F.col("first"), F.col("last")))
    verdicts = held.groupBy("id").agg(F.bool_or("include").alias("inc"), F.bool_or(~F.col("include")).alias("exc"), F.count("*").alias("trace"))
    verdict = F.when(F.col("exc"), "excluded").when(F.col("inc"), "included").otherwise("unknown")
    return subjects.select("id").join(verdicts, "id", "left").select("id", verdict.alias("verdict"), F.coalesce("trace", F.lit(0)).alias("trace"))


def visible(assertions: DataFrame, revision: int) -> DataFrame:
    """Assertions known at a revision: first <= revision <= through."""
    return assertions.where((F.col("first") <= revision) & (F.col("through") >= revision))
