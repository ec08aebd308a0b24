"""Combined events: a result counts if every component of its kind has one and none of them is terminal."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def completeness(rows: DataFrame, ids: list[str], components: dict[str, list[str]]) -> DataFrame:
    """ids, kind, completion (complete, incomplete, terminal, foreign_component, unknown_kind) and total (of complete ones).

    rows: ids, kind, component, terminal (a did-not-start, did-not-finish, disqualified or no-mark component) and
    points, one row a component. Counts combine before the shuffle; no list of components is gathered.
    """
    lists = F.create_map(*[x for kind, names in components.items() for x in (F.lit(kind), F.array(*map(F.lit, names)))])
    known = rows.withColumn("list", F.try_element_at(lists, F.col("kind")))
    own = F.coalesce(F.array_contains("list", F.col("component")), F.lit(False))
    out = known.groupBy(*ids, "kind").agg(F.max(F.size("list")).alias("need"), F.count_if(own).alias("have"), F.count_if(~own).alias("foreign"), F.coalesce(F.bool_or(own & F.col("terminal")), F.lit(False)).alias("stopped"), F.sum(F.when(own, F.col("points"))).alias("sum"))
    state = F.when(F.coalesce(F.col("need"), F.lit(0)) <= 0, "unknown_kind").when(F.col("foreign") > 0, "foreign_component").when(F.col("stopped"), "terminal").when(F.col("have") < F.col("need"), "incomplete").otherwise("complete")
    return out.withColumn("completion", state).select(*ids, "kind", "completion", F.when(F.col("completion") == "complete", F.col("sum")).alias("total"))
