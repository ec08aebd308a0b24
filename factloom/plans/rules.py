"""Queries of operators with many rules: participation, ten-part comparison keys, combined events."""

from __future__ import annotations

from pyspark.sql import functions as F

from factloom.operators import best, combined, participation
from factloom.plans.registry import query
from factloom.sources.tables import load

# Facts that each order's key makes, so that every rule is met; beside each, the twin's own statement of the rules.
FACTS = """SELECT o_orderkey AS k, strftime(o_orderdate, '%Y-%m-%d') AS day, o_orderkey % 13 AS d, o_orderkey % 17 AS own, o_orderkey % 19 AS coh, CAST(2019 + o_orderkey % 6 AS INT) AS yr, o_orderkey % 7 AS ctx, o_orderkey % 11 AS st, o_orderkey % 5 AS win FROM orders"""


@query(f"""
WITH f AS ({FACTS}),
g AS (SELECT *, d > 2 AS usable, coh > 1 AS known, yr BETWEEN 2020 AND 2023 AS chosen FROM f),
h AS (SELECT *, win IN (1, 2, 4) AND chosen OR win = 3 AND (NOT known) AND yr + 1 BETWEEN 2020 AND 2023 AS applies,
  CASE win WHEN 1 THEN day <= '1996-06-30' ELSE true END AS inside, st IN (5, 6, 7, 8, 9, 10) OR st = 1 AND day <= '1996-12-31' AS high FROM g),
r AS (SELECT *, [d = 0, d = 1, d = 2, usable AND day > '2000-12-31', usable AND day < '1996-01-01', usable AND day > '2000-06-30', own = 0, own = 1, coh = 0, coh = 1, known AND NOT chosen, ctx = 0,
  ctx = 1 OR usable AND st = 5, st IN (0, 2, 3, 4), usable AND st = 1 AND NOT high, usable AND NOT applies, usable AND applies AND NOT inside, usable AND st IN (2, 5), usable AND st = 3, usable AND st = 4, usable AND applies AND win = 2 AND day > '1997-12-31'] AS bits FROM h)
SELECT k AS o_orderkey, CAST(list_sum(list_transform(range(1, 22), lambda i: CASE WHEN bits[i] THEN 1 << CAST(i - 1 AS INT) ELSE 0 END)) AS BIGINT) AS reasons,
  CASE WHEN NOT list_contains(bits, true) THEN 'eligible' WHEN bits[4] OR bits[5] OR bits[6] OR bits[11] OR bits[17] OR bits[18] OR bits[19] OR bits[20] THEN 'excluded' ELSE 'unresolved' END AS outcome FROM r""")
def participation_mask(spark, sf):
    """All 21 reasons for each order's facts, and the outcome they give."""
    k, day = F.col("o_orderkey"), F.date_format("o_orderdate", "yyyy-MM-dd")
    year = (F.lit(2019) + k % 6).cast("int")
    fact = lambda kind, a, b: F.struct(F.lit(kind).alias("status"), F.lit(a).alias("first"), F.lit(b).alias("last"))
    window = lambda cohort, a, b: F.struct(cohort.cast("int").alias("cohort"), F.lit(a).alias("first"), F.lit(b).alias("last"))
    always = ("1990-01-01", "2099-12-31")
    pick = lambda n, options, rest: F.element_at(F.array(*options, *[rest] * (n - len(options))), (k % n + 1).cast("int"))
    none = F.array().cast("array<struct<status:string,first:string,last:string>>")
    statuses = [none, F.array(fact("high_school", "1990-01-01", "1996-12-31")), *[F.array(fact(s, *always)) for s in ("collegiate", "middle_school", "post_graduation")], F.array(fact("high_school", *always), fact("collegiate", *always))]
    windows = [F.array().cast("array<struct<cohort:int,first:string,last:string>>"), F.array(window(year, "1990-01-01", "1996-06-30")), F.array(window(year, "1990-01-01", "1997-12-31"), window(year, *always)), F.array(window(year + 1, *always))]
    words = lambda *w: F.array(*map(F.lit, w)).cast("array<string>")
    facts = load(spark, sf, "orders").select(
        "o_orderkey",
        pick(13, [F.lit(None).cast("string"), F.lit("1995"), F.lit("1995-13-40")], day).alias("date"),
        pick(17, [F.lit("missing"), F.lit("conflicting")], F.lit("bound")).alias("ownership"),
        pick(19, [F.lit("missing"), F.lit("conflicting")], F.lit("resolved")).alias("cohort"),
        year.alias("year"),
        pick(7, [words(), words("scholastic", "club")], words("scholastic")).alias("contexts"),
        pick(11, statuses, F.array(fact("high_school", *always))).alias("statuses"),
        pick(5, windows, F.array(window(year, *always))).alias("windows"),
    )
    out = participation.assess(facts, "1996-01-01", "2000-06-30", "2000-12-31", [2020, 2021, 2022, 2023])
    return out.select("o_orderkey", F.col("reasons").cast("long").alias("reasons"), "outcome")


@query("""
WITH k AS (SELECT o_custkey AS athlete, p_type AS event_kind, CASE o_orderkey % 3 WHEN 0 THEN 'indoor' WHEN 1 THEN 'outdoor' ELSE 'xc' END AS surface,
    CASE WHEN p_size <= 10 THEN 'n/a' WHEN l_tax IS NULL THEN 'unknown' WHEN l_tax <= 0.04 THEN 'legal' ELSE 'assisted' END AS wind, CASE WHEN p_size > 25 THEN 'fat' ELSE 'hand' END AS timing,
    l_returnflag AS measure, CASE WHEN o_orderkey % 3 = 2 THEN l_orderkey END AS context, p_brand AS specification, CASE WHEN o_orderkey % 3 = 2 THEN 'same_course' ELSE 'any_course' END AS comparison,
    CASE WHEN l_discount > 0.05 THEN 'adjusted' END AS adjustment, l_extendedprice AS mark, l_shipdate AS seen, l_orderkey, l_linenumber
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey),
r AS (SELECT *, row_number() OVER (PARTITION BY athlete, event_kind, surface, wind, timing, measure, context, specification, comparison, adjustment ORDER BY CASE WHEN measure = 'A' THEN -mark ELSE mark END, seen, l_orderkey, l_linenumber) AS rn FROM k)
SELECT athlete, event_kind, surface, wind, timing, measure, context, specification, comparison, adjustment, mark, l_orderkey, l_linenumber FROM r WHERE rn = 1""")
def ten_part_bests(spark, sf):
    """The best mark under each whole comparison key; a measure of A is better when larger, the others when smaller."""
    o, p = load(spark, sf, "orders").select("o_orderkey", "o_custkey"), load(spark, sf, "part").select("p_partkey", "p_type", "p_size", "p_brand")
    l = load(spark, sf, "lineitem").join(o, F.col("l_orderkey") == F.col("o_orderkey")).join(p, F.col("l_partkey") == F.col("p_partkey"))
    xc = F.col("o_orderkey") % 3 == 2
    key = {
        "athlete": F.col("o_custkey"),
        "event_kind": F.col("p_type"),
        "surface": F.when(F.col("o_orderkey") % 3 == 0, "indoor").when(xc, "xc").otherwise("outdoor"),
        "wind": F.when(F.col("p_size") <= 10, "n/a").when(F.col("l_tax").isNull(), "unknown").when(F.col("l_tax") <= 0.04, "legal").otherwise("assisted"),
        "timing": F.when(F.col("p_size") > 25, "fat").otherwise("hand"),
        "measure": F.col("l_returnflag"),
        "context": F.when(xc, F.col("l_orderkey")),
        "specification": F.col("p_brand"),
        "comparison": F.when(xc, "same_course").otherwise("any_course"),
        "adjustment": F.when(F.col("l_discount") > 0.05, "adjusted"),
    }
    rows = l.select(*[c.alias(n) for n, c in key.items()], F.col("l_extendedprice").alias("mark"), "l_shipdate", "l_orderkey", "l_linenumber")
    out = best.best_per_key(rows, list(key), "mark", F.col("measure") == "A", "l_shipdate", ["l_orderkey", "l_linenumber"], [])
    return out.select(*key, "mark", "l_orderkey", "l_linenumber")


COMPONENTS = {"A": ["1", "2", "3", "4"], "N": ["1", "2", "3"], "R": ["1", "2", "3", "4", "5"]}


@query("""
WITH c AS (SELECT l_orderkey, l_linenumber AS component, l_returnflag AS terminal, l_quantity AS points, min(l_returnflag) OVER (PARTITION BY l_orderkey) AS kind, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate, l_partkey, l_suppkey, l_extendedprice) AS rn FROM lineitem),
d AS (SELECT l_orderkey, kind, component, points, CASE kind WHEN 'A' THEN 4 WHEN 'N' THEN 3 ELSE 5 END AS need, terminal = 'R' AND component = 2 AS dnf FROM c WHERE rn = 1),
e AS (SELECT l_orderkey, kind, need, count(*) FILTER (WHERE component <= need) AS have, bool_or(dnf AND component <= need) AS stopped, count(*) FILTER (WHERE component > need) AS foreign_parts, CAST(sum(points) FILTER (WHERE component <= need) AS DOUBLE) AS total FROM d GROUP BY ALL)
SELECT l_orderkey, kind, CASE WHEN foreign_parts > 0 THEN 'foreign_component' WHEN coalesce(stopped, false) THEN 'terminal' WHEN have < need THEN 'incomplete' ELSE 'complete' END AS completion, CASE WHEN foreign_parts = 0 AND NOT coalesce(stopped, false) AND have = need THEN total END AS total FROM e""")
def combined_events(spark, sf):
    """Combined events against each kind's list of components: complete only with all of them and no terminal one."""
    from pyspark.sql import Window as W

    l = load(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag", "l_quantity", "l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice")
    kind = F.min("l_returnflag").over(W.partitionBy("l_orderkey"))
    order = F.struct("l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice")
    one = l.withColumn("kind", kind).groupBy("l_orderkey", "kind", "l_linenumber").agg(F.min_by(F.struct("l_returnflag", "l_quantity"), order).alias("w"))
    rows = one.select("l_orderkey", "kind", F.col("l_linenumber").cast("string").alias("component"), ((F.col("w.l_returnflag") == "R") & (F.col("l_linenumber") == 2)).alias("terminal"), F.col("w.l_quantity").alias("points"))
    return combined.completeness(rows, ["l_orderkey"], COMPONENTS)
