"""Entity resolution: labels, aliases, weak keys, components, redirects."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factloom.operators.durable import cut


def resolve_labels(labels: DataFrame, index: DataFrame, on: list[str], name: str, steps: list[tuple[str, str]]) -> DataFrame:
    """labels resolved by the first step that finds any id: (step, column of labels to look up).

    index: on + name + id. A step with one id resolves; with several it is ambiguous and stops.
    """
    ids = index.groupBy(*on, name).agg(F.count_distinct("id").alias("n"), F.min("id").alias("id"))
    out = labels
    for step, column in steps:
        found = ids.select(*[F.col(c).alias(f"__{c}") for c in on], F.col(name).alias("__name"), F.col("n").alias(f"n_{step}"), F.col("id").alias(f"id_{step}"))
        same = [F.col(c) == F.col(f"__{c}") for c in on]
        condition = F.col(column) == F.col("__name")
        for x in same:
            condition = condition & x
        out = out.join(found, condition, "left").drop("__name", *[f"__{c}" for c in on])
    outcome, match = F.lit("unresolved"), F.lit(None).cast("string")
    for step, _ in reversed(steps):
        hit = F.col(f"n_{step}").isNotNull()
        outcome = F.when(hit & (F.col(f"n_{step}") > 1), "ambiguous").when(hit, step).otherwise(outcome)
        match = F.when(hit, F.when(F.col(f"n_{step}") == 1, F.col(f"id_{step}").cast("string"))).otherwise(match)
    return out.withColumn("outcome", outcome).withColumn("match", match).drop(*[f"{x}_{s}" for s, _ in steps for x in ("n", "id")])


def collapse_aliases(df: DataFrame, id_col: str, canonical: str, unions: list[str], unanimous: str) -> DataFrame:
    """Rows of one canonical id as one: list fields unioned, the unanimous field only if all known agree."""
    agreed = F.when(F.min(unanimous) == F.max(unanimous), F.min(unanimous))
    merged = [F.array_join(F.array_sort(F.collect_set(F.col(c).cast("string"))), ",").alias(c) for c in unions]
    return df.groupBy(F.col(canonical).alias("canonical")).agg(F.count("*").alias("members"), F.max((F.col(id_col) == F.col(canonical)).cast("int")).alias("has_representative"), agreed.alias(unanimous), *merged)


def collapse_weak(strong: DataFrame, weak: DataFrame, keys: list[str], id_col: str) -> DataFrame:
    """Weak rows join the one strong row that claims their weak key; else they stay, with a note."""
    claims = strong.groupBy(*keys).agg(F.count_distinct(id_col).alias("claims"), F.min(id_col).alias("target"))
    note = F.when(F.col("claims").isNull(), "kept").when(F.col("claims") == 1, "absorbed").otherwise("kept_ambiguous")
    return weak.join(claims, keys, "left").withColumn("note", note).withColumn("target", F.when(F.col("claims") == 1, F.col("target"))).drop("claims")


def components(edges: DataFrame) -> DataFrame:
    """(v, label) of the undirected edges (a, b): label is the least vertex reachable.

    Pointers to the least neighbour are doubled to their roots and the edges contracted, so the
    number of rounds grows with the logarithm of a chain's length; each round's state is a table on disk.
    """
    left = cut(edges.select("a", "b").where("a <> b").distinct(), "component-edges")
    labels = None
    while not left.isEmpty():
        ends = left.unionByName(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        point = cut(ends.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("v"), F.least("a", "m").alias("label")), "component-point")
        while True:
            hop = point.select(F.col("v").alias("label"), F.col("label").alias("next"))
            point = cut(point.join(hop, "label").select("v", F.col("next").alias("label"), (F.col("next") != F.col("label")).alias("moved")), "component-hop")
            if point.where("moved").isEmpty():
                break
        names = point.select("v", "label")
        if labels is None:
            labels = names
        else:
            roots = names.select(F.col("v").alias("label"), F.col("label").alias("root"))
            labels = cut(labels.join(roots, "label", "left").select("v", F.coalesce("root", "label").alias("label")), "component-labels")
        ra, rb = names.select(F.col("v").alias("a"), F.col("label").alias("la")), names.select(F.col("v").alias("b"), F.col("label").alias("lb"))
        left = cut(left.join(ra, "a").join(rb, "b").where("la <> lb").select(F.col("la").alias("a"), F.col("lb").alias("b")).distinct(), "component-edges")
    return labels if labels is not None else left.select(F.col("a").alias("v"), F.col("b").alias("label"))


def redirects(links: DataFrame) -> DataFrame:
    """(id, canonical, outcome) of src -> dst redirects: pointers are doubled until none moves.

    outcome is canonical, or cyclic for ids whose chain never ends; two targets make an id ambiguous.
    """
    heads = links.groupBy("src").agg(F.min("dst").alias("dst"), F.count_distinct("dst").alias("n"))
    point = cut(heads.select(F.col("src").alias("id"), F.col("dst").alias("at"), (F.col("n") > 1).alias("ambiguous"), F.lit(1).cast("long").alias("steps")), "redirect")
    total = point.count()
    while True:
        hop = point.select(F.col("id").alias("at"), F.col("at").alias("next"), F.col("ambiguous").alias("more"), F.col("steps").alias("add"))
        point = cut(point.join(hop, "at", "left").select("id", F.coalesce("next", "at").alias("at"), (F.col("ambiguous") | F.coalesce("more", F.lit(False))).alias("ambiguous"), (F.col("steps") + F.coalesce("add", F.lit(0))).alias("steps"), F.col("next").isNotNull().alias("moved")), "redirect")
        if point.where(F.col("moved") & (F.col("steps") <= total)).isEmpty():
            break
    outcome = F.when(F.col("ambiguous"), "ambiguous").when(F.col("steps") > total, "cyclic").otherwise("canonical")
    return point.select("id", F.when(outcome == "canonical", F.col("at")).alias("canonical"), outcome.alias("outcome"))
