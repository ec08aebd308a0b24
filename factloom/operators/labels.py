"""Printed labels to entities: every rule of the resolution, each an equi-join on a lookup key.

A label is looked up, in this order, until a lookup finds anything: its normalized name; the name with one
abbreviation written out (each in turn); the name without a trailing single letter (a squad), plain and
written out; and at last a partial match. One id found resolves the label, several make it ambiguous and end the search.
Names count before aliases. A partial match is an entity whose name has one word more than the label's first
words and that word begins with the label's last one, or whose name ends with the whole label: the first
is a join on the leading words, the second on every trailing part of a name.

Defined cases: null or empty label: absent; an entity without a place is in no lookup; repeated rows of an entity are one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from factloom.functions.scalars import normalize_name

#: Abbreviations in labels and what they stand for; fixed values.
ABBREVIATIONS = (("milw.", "milwaukee"), ("univ.", "university"), ("cath.", "catholic"), ("acad.", "academy"), ("ec ", "eau claire "), ("wi rapids", "wisconsin rapids"))


def without_squad(name: Column) -> Column:
    """The name without a last word of one letter; null if it has none."""
    return F.when(name.rlike("^.+ .$"), F.substring(name, F.lit(1), F.length(name) - 2))


def lookups(raw: Column) -> Column:
    """The keys of a label in order: an array of (step, kind, key)."""
    name, low = normalize_name(raw), F.lower(raw)
    bare = without_squad(name)
    out = [(name != "", "exact", name)]
    written = [(F.contains(low, F.lit(a)), normalize_name(F.replace(low, F.lit(a), F.lit(b)))) for a, b in ABBREVIATIONS]
    out += [(has & (name != ""), "abbreviation", full) for has, full in written]
    out += [(bare.isNotNull(), "exact", bare)]
    out += [(bare.isNotNull() & has, "abbreviation", F.coalesce(without_squad(full), full)) for has, full in written]
    each = [F.when(on, F.struct(F.lit(step).alias("step"), F.lit(kind).alias("kind"), key.alias("key"))) for step, (on, kind, key) in enumerate(out)]
    return F.filter(F.array(*each), lambda x: x.isNotNull())


def names_and_aliases(entities: DataFrame) -> DataFrame:
    """place, key, n (ids that have it) and id: names, and aliases that are no name. entities: place, name, aliases, id."""
    known = entities.where("place is not null")
    names = known.groupBy("place", F.col("name").alias("key")).agg(F.count_distinct("id").alias("n"), F.min("id").alias("id"))
    aliases = known.select("place", F.explode("aliases").alias("alias"), "id").groupBy("place", normalize_name("alias").alias("key")).agg(F.count_distinct("id").alias("n"), F.min("id").alias("id"))
    return names.unionByName(aliases.join(names, ["place", "key"], "left_anti"))


def partials(labels: DataFrame, entities: DataFrame) -> DataFrame:
    """row, n and id of partial matches. labels: row, place, key (two words at least)."""
    known = entities.where("place is not null").select("place", "name", "id").distinct()
    head = lambda c: F.regexp_extract(c, "^(.+) [^ ]+$", 1)
    last = lambda c: F.substring_index(c, " ", -1)
    begun = known.select("place", head("name").alias("head"), last("name").alias("rest"), "id").where("head <> ''")
    longer = labels.select("row", "place", head("key").alias("head"), last("key").alias("last")).join(begun, ["place", "head"]).where(F.startswith("rest", "last"))
    words = F.split("name", " ")
    tails = F.transform(F.sequence(F.lit(2), F.size(words)), lambda i: F.array_join(F.slice(words, i, F.size(words)), " "))
    ended = known.where(F.size(words) > 1).select("place", F.explode(tails).alias("key"), "id")
    both = longer.select("row", "id").unionByName(labels.join(ended, ["place", "key"]).select("row", "id"))
    return both.groupBy("row").agg(F.count_distinct("id").alias("n"), F.min("id").alias("id"))


def resolve(labels: DataFrame, entities: DataFrame) -> DataFrame:
    """row, outcome (exact, abbreviation, partial, ambiguous or absent) and id. labels: row, place, raw.

    entities: place, name (normalized), aliases (array) and id.
    """
    keys = labels.select("row", "place", F.explode(lookups(F.col("raw"))).alias("k")).select("row", "place", "k.*")
    found = keys.join(names_and_aliases(entities), ["place", "key"]).select("row", "step", "kind", "n", "id")
    name = normalize_name("raw")
    last = labels.select("row", "place", F.coalesce(without_squad(name), name).alias("key")).where("key like '% %'")
    found = found.unionByName(partials(last, entities).select("row", F.lit(99).alias("step"), F.lit("partial").alias("kind"), "n", "id"))
    first = found.groupBy("row").agg(F.min_by(F.struct("kind", "n", "id"), "step").alias("f"))
    out = labels.select("row").join(first, "row", "left")
    outcome = F.when(F.col("f").isNull(), "absent").when(F.col("f.n") > 1, "ambiguous").otherwise(F.col("f.kind"))
    return out.select("row", outcome.alias("outcome"), F.when(F.col("f.n") == 1, F.col("f.id")).alias("id"))
