"""Best per key, ties, contests, windows, ranks, pages and samples."""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from factloom.operators import best, guards, ranks
from factloom.plans.registry import query
from factloom.sources.tables import day, load, money

SHIP = "lineitem JOIN orders ON l_orderkey = o_orderkey"


def _shipments(spark, sf):
    o = load(spark, sf, "orders").select("o_orderkey", "o_custkey")
    l = load(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag", "l_linestatus", "l_extendedprice", "l_shipdate", "l_suppkey")
    return l.join(o, F.col("l_orderkey") == F.col("o_orderkey"))


@query(f"""
SELECT o_custkey, l_returnflag, l_extendedprice, strftime(l_shipdate, '%Y-%m-%d') AS ship_day, l_orderkey, l_linenumber, candidates FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey, l_returnflag ORDER BY l_extendedprice DESC, l_shipdate, l_orderkey, l_linenumber) AS rn, count(*) OVER (PARTITION BY o_custkey, l_returnflag) AS candidates FROM {SHIP})
WHERE rn = 1""")
def best_ship_price(spark, sf):
    """The flagship: the dearest shipment of each customer and return flag."""
    out = best.best_per_key(_shipments(spark, sf), ["o_custkey", "l_returnflag"], "l_extendedprice", True, "l_shipdate", ["l_orderkey", "l_linenumber"], [])
    return out.select("o_custkey", "l_returnflag", "l_extendedprice", day("l_shipdate").alias("ship_day"), "l_orderkey", "l_linenumber", "candidates")


@query("""
WITH b AS (SELECT l_suppkey, max(l_quantity) AS best FROM lineitem GROUP BY 1)
SELECT DISTINCT l_suppkey, best, l_orderkey FROM lineitem JOIN b USING (l_suppkey) WHERE l_quantity = best""")
def best_with_ties(spark, sf):
    """Every order that ties for a supplier's greatest quantity."""
    l = load(spark, sf, "lineitem").select("l_suppkey", "l_quantity", "l_orderkey")
    return best.tied_ids(l, ["l_suppkey"], "l_quantity", True, "l_orderkey")


CONTEXT = "SELECT l_suppkey, l_orderkey, l_linenumber, min(l_extendedprice) AS low, max(l_extendedprice) AS high FROM lineitem GROUP BY ALL"


@query(f"""
SELECT l_suppkey, l_extendedprice, l_orderkey, l_linenumber, candidates FROM (
  SELECT l_suppkey, low AS l_extendedprice, l_orderkey, l_linenumber, row_number() OVER (PARTITION BY l_suppkey ORDER BY low, l_orderkey, l_linenumber) AS rn, count(*) OVER (PARTITION BY l_suppkey) AS candidates
  FROM ({CONTEXT}) WHERE low = high) WHERE rn = 1""")
def best_contested(spark, sf):
    """Contexts with two values give no candidate; the best of the settled ones wins."""
    l = load(spark, sf, "lineitem").select("l_suppkey", "l_orderkey", "l_linenumber", "l_extendedprice")
    settled, _ = best.split_contested(l, ["l_suppkey"], ["l_orderkey", "l_linenumber"], "l_extendedprice")
    settled = settled.withColumn("none", F.lit(None).cast("date"))
    out = best.best_per_key(settled, ["l_suppkey"], "l_extendedprice", False, "none", ["l_orderkey", "l_linenumber"], [])
    return out.select("l_suppkey", "l_extendedprice", "l_orderkey", "l_linenumber", "candidates")


@query("SELECT o_custkey, l_returnflag, l_suppkey, count(*) AS n FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY ALL HAVING min(l_extendedprice) <> max(l_extendedprice)")
def contested_contexts(spark, sf):
    _, contested = best.split_contested(_shipments(spark, sf), ["o_custkey", "l_returnflag"], ["l_suppkey"], "l_extendedprice")
    return contested.select("o_custkey", "l_returnflag", "l_suppkey", "n")


@query(f"""
WITH k AS (SELECT o_custkey, l_extendedprice, l_orderkey, l_linenumber, unnest(['any', 'flag:' || l_returnflag]) AS course FROM {SHIP})
SELECT o_custkey, course, min(l_extendedprice) AS best, count(*) AS candidates FROM k GROUP BY ALL""")
def two_keys_per_row(spark, sf):
    """Each row competes under the general key and under its own course's key."""
    rows = _shipments(spark, sf).select("o_custkey", "l_extendedprice", F.explode(F.array(F.lit("any"), F.concat(F.lit("flag:"), "l_returnflag"))).alias("course"))
    return rows.groupBy("o_custkey", "course").agg(F.min("l_extendedprice").alias("best"), F.count("*").alias("candidates"))


EDGES = [1, 2, 5, 10, 20, 30, 40, 50, 60, 70, 80, 90, 100, 150, 200, 300, 500, 1000, 5000, 100000]


@query(f"""
WITH b AS (SELECT event_type, coalesce((SELECT min(e) FROM (SELECT unnest({EDGES}) AS e) WHERE e >= value), {EDGES[-1]}) AS edge FROM events),
h AS (SELECT event_type, edge, count(*) AS n FROM b GROUP BY ALL),
c AS (SELECT *, sum(n) OVER (PARTITION BY event_type ORDER BY edge) AS upto, sum(n) OVER (PARTITION BY event_type) AS total FROM h)
SELECT event_type, p, min(edge) AS edge FROM c CROSS JOIN (VALUES (50), (90), (99)) t(p) WHERE upto >= greatest(1, ceil(total * p / 100.0)) GROUP BY ALL""")
def latency_percentiles(spark, sf):
    """Nearest rank over fixed buckets: the answer is a bucket's upper edge; beyond the last, the last."""
    edge = F.lit(EDGES[-1])
    for e in reversed(EDGES):
        edge = F.when(F.col("value") <= e, e).otherwise(edge)
    h = load(spark, sf, "events").groupBy("event_type", edge.alias("edge")).agg(F.count("*").alias("n"))
    by = W.partitionBy("event_type")
    c = h.withColumn("upto", F.sum("n").over(by.orderBy("edge"))).withColumn("total", F.sum("n").over(by)).withColumn("p", F.explode(F.array(F.lit(50), F.lit(90), F.lit(99))))
    return c.where("upto >= greatest(1, ceil(total * p / 100.0))").groupBy("event_type", "p").agg(F.min("edge").alias("edge"))


@query("SELECT o_orderkey, o_totalprice, o_orderpriority FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 100")
def top_k_sorted(spark, sf):
    """The limit is the feature: each task keeps its own hundred, no full sort."""
    return load(spark, sf, "orders").select("o_orderkey", "o_totalprice", "o_orderpriority").orderBy(F.desc("o_totalprice"), "o_orderkey").limit(100)


@query("SELECT o_orderstatus, o_orderkey, CAST(floor((row_number() OVER (PARTITION BY o_orderstatus ORDER BY o_orderkey) - 1) / 1000) AS BIGINT) + 1 AS page FROM orders")
def sheet_pages(spark, sf):
    """Page numbers of a thousand rows a sheet family."""
    o = ranks.numbered(load(spark, sf, "orders").select("o_orderstatus", "o_orderkey"), ["o_orderstatus"], ["o_orderkey"])
    return o.select("o_orderstatus", "o_orderkey", (F.floor((F.col("rank") - 1) / 1000) + 1).cast("long").alias("page"))


@query("SELECT o_orderpriority, o_orderkey FROM (SELECT o_orderpriority, o_orderkey, row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_orderkey) AS rn FROM orders) WHERE (rn - 1) % 25 = 0")
def systematic_sample(spark, sf):
    """Every 25th row of a group (sampling is the feature)."""
    o = ranks.numbered(load(spark, sf, "orders").select("o_orderpriority", "o_orderkey"), ["o_orderpriority"], ["o_orderkey"])
    return o.where("(rank - 1) % 25 = 0").drop("rank")


@query("""
SELECT l_orderkey, l_linenumber, l_partkey, prev AS previous_part FROM (
  SELECT l_orderkey, l_linenumber, l_partkey, lag(l_partkey) OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_partkey, l_suppkey, l_extendedprice) AS prev FROM lineitem)
WHERE prev IS NOT NULL AND prev <> l_partkey""")
def adjacent_duplicates(spark, sf):
    before = F.lag("l_partkey").over(W.partitionBy("l_orderkey", "l_linenumber").orderBy("l_partkey", "l_suppkey", "l_extendedprice"))
    l = load(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", before.alias("previous_part"))
    return l.where("previous_part is not null and previous_part <> l_partkey")


@query("""
SELECT o_orderkey, o_custkey, rank() OVER w AS rnk, dense_rank() OVER w AS dense, ntile(4) OVER u AS quarter, lead(o_orderkey) OVER u AS following,
  first_value(o_orderkey) OVER u AS first_key, count(*) OVER (PARTITION BY o_custkey ORDER BY o_orderkey ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS in_frame
FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderpriority), u AS (PARTITION BY o_custkey ORDER BY o_orderkey)""")
def ranking_suite(spark, sf):
    w, u = W.partitionBy("o_custkey").orderBy("o_orderpriority"), W.partitionBy("o_custkey").orderBy("o_orderkey")
    return load(spark, sf, "orders").select("o_orderkey", "o_custkey", F.rank().over(w).alias("rnk"), F.dense_rank().over(w).alias("dense"), F.ntile(4).over(u).alias("quarter"), F.lead("o_orderkey").over(u).alias("following"), F.first("o_orderkey").over(u).alias("first_key"), F.count("*").over(u.rowsBetween(-2, 0)).alias("in_frame"))


@query("""
SELECT l_returnflag, l_linestatus, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS revenue, count(*) AS n, grouping(l_returnflag) AS g1, grouping(l_linestatus) AS g2
FROM lineitem GROUP BY CUBE (l_returnflag, l_linestatus)""")
def cube_sets(spark, sf):
    l = load(spark, sf, "lineitem")
    return l.cube("l_returnflag", "l_linestatus").agg(F.sum(money("l_extendedprice")).cast("double").alias("revenue"), F.count("*").alias("n"), F.grouping("l_returnflag").cast("int").alias("g1"), F.grouping("l_linestatus").cast("int").alias("g2"))


@query("""
SELECT o_orderstatus, o_orderpriority, count(*) AS n FROM orders GROUP BY GROUPING SETS ((o_orderstatus), (o_orderpriority), ())""")
def grouping_sets(spark, sf):
    o = load(spark, sf, "orders")
    return o.groupingSets([[F.col("o_orderstatus")], [F.col("o_orderpriority")], []], F.col("o_orderstatus"), F.col("o_orderpriority")).agg(F.count("*").alias("n"))


@query()
def approx_distinct(spark, sf):
    """A sketch of distinct parts by return flag (approximate, so no SQL twin)."""
    return load(spark, sf, "lineitem").groupBy("l_returnflag").agg(F.approx_count_distinct("l_partkey", 0.02).alias("parts"))


@query("SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1 HAVING count(*) <= 12")
def group_guard(spark, sf):
    """Groups over the budget are refused whole, never cut."""
    kept, _ = guards.refuse_groups(load(spark, sf, "orders").select("o_custkey"), ["o_custkey"], 12)
    return kept.groupBy("o_custkey").agg(F.count("*").alias("n"))


@query("""
WITH d AS (SELECT user_id, strftime(ts, '%Y-%m-%d') AS day, string_agg(DISTINCT event_type, ',' ORDER BY event_type) AS page FROM events GROUP BY ALL)
SELECT user_id, day FROM (SELECT *, lag(page) OVER (PARTITION BY user_id ORDER BY day) AS prev FROM d) WHERE page = prev""")
def page_repeat_detect(spark, sf):
    """A page whose set of entries equals the previous page's is quarantined."""
    page = F.array_join(F.array_sort(F.collect_set("event_type")), ",")
    d = load(spark, sf, "events").groupBy("user_id", day("ts").alias("day")).agg(page.alias("page"))
    return d.withColumn("prev", F.lag("page").over(W.partitionBy("user_id").orderBy("day"))).where("page = prev").select("user_id", "day")


@query("""
SELECT p_brand, arg_min(p_name, ROW(-len(string_split(p_name, ' ')), length(p_name), p_name)) AS preferred, count(DISTINCT p_name) AS spellings
FROM part GROUP BY 1""")
def preferred_spelling(spark, sf):
    """The spelling with the most words, then the shortest, then the smallest text."""
    rank = F.struct((-F.size(F.split("p_name", " "))).alias("a"), F.length("p_name").alias("b"), "p_name")
    return load(spark, sf, "part").groupBy("p_brand").agg(F.min_by("p_name", rank).alias("preferred"), F.count_distinct("p_name").alias("spellings"))
