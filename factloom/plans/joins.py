"""Queries over joins, scopes, diffs and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from factloom.operators import relate
from factloom.plans.registry import query
from factloom.sources.tables import day, load, money


@query("""
SELECT l_orderkey, l_linenumber, l_quantity, o_orderstatus, c_name, c_mktsegment, n_name, r_name
FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey LEFT JOIN customer ON o_custkey = c_custkey
LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey""")
def star_projection(spark, sf):
    """N:1 left joins; only the needed columns are read. Nation and region are 25 and 5 rows in any scale."""
    l, o, c = (load(spark, sf, t) for t in ("lineitem", "orders", "customer"))
    n, r = load(spark, sf, "nation"), load(spark, sf, "region")
    out = l.select("l_orderkey", "l_linenumber", "l_quantity").join(o.select("o_orderkey", "o_custkey", "o_orderstatus"), F.col("l_orderkey") == F.col("o_orderkey"), "left")
    out = out.join(c.select("c_custkey", "c_name", "c_mktsegment", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey"), "left")
    out = out.join(n, F.col("c_nationkey") == F.col("n_nationkey"), "left").join(r, F.col("n_regionkey") == F.col("r_regionkey"), "left")
    return out.select("l_orderkey", "l_linenumber", "l_quantity", "o_orderstatus", "c_name", "c_mktsegment", "n_name", "r_name")


@query("SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING' AND c_acctbal > 0)")
def cohort_semi_join(spark, sf):
    cohort = load(spark, sf, "customer").where("c_mktsegment = 'BUILDING' and c_acctbal > 0").select("c_custkey")
    return load(spark, sf, "orders").select("o_orderkey", "o_custkey").join(cohort, F.col("o_custkey") == F.col("c_custkey"), "left_semi")


@query("SELECT c_custkey, c_name FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'F')")
def orphan_anti_join(spark, sf):
    done = load(spark, sf, "orders").where("o_orderstatus = 'F'").select("o_custkey")
    return load(spark, sf, "customer").select("c_custkey", "c_name").join(done, F.col("o_custkey") == F.col("c_custkey"), "left_anti")


@query("""
SELECT c_custkey, n_name, CASE WHEN r_name IN ('ASIA', 'EUROPE') THEN 'in_scope' ELSE 'excluded' END AS scope
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""")
def scope_filter_complement(spark, sf):
    places = load(spark, sf, "nation").join(load(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    rows = load(spark, sf, "customer").select("c_custkey", "c_nationkey").join(places, F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", "n_name", "r_name")
    inside, outside = relate.split_scope(rows, F.col("r_name").isin("ASIA", "EUROPE"))
    return inside.select("c_custkey", "n_name", F.lit("in_scope").alias("scope")).unionByName(outside.select("c_custkey", "n_name", F.lit("excluded").alias("scope")))


@query("""
WITH a AS (SELECT o_custkey, count(*) AS n, max(o_orderpriority) AS top FROM orders WHERE o_orderdate < TIMESTAMP '1997-01-01' GROUP BY 1),
b AS (SELECT o_custkey, count(*) AS n, max(o_orderpriority) AS top FROM orders WHERE o_orderdate >= TIMESTAMP '1995-01-01' GROUP BY 1)
SELECT coalesce(a.o_custkey, b.o_custkey) AS o_custkey,
  CASE WHEN a.o_custkey IS NULL THEN 'added' WHEN b.o_custkey IS NULL THEN 'removed' ELSE 'modified' END AS change,
  CASE WHEN a.o_custkey IS NULL OR b.o_custkey IS NULL THEN '' ELSE concat_ws(',', CASE WHEN a.n IS DISTINCT FROM b.n THEN 'n' END, CASE WHEN a.top IS DISTINCT FROM b.top THEN 'top' END) END AS changed
FROM a FULL JOIN b ON a.o_custkey = b.o_custkey
WHERE a.o_custkey IS NULL OR b.o_custkey IS NULL OR a.n IS DISTINCT FROM b.n OR a.top IS DISTINCT FROM b.top""")
def snapshot_diff(spark, sf):
    o = load(spark, sf, "orders")
    of = lambda rows: rows.groupBy("o_custkey").agg(F.count("*").alias("n"), F.max("o_orderpriority").alias("top"))
    return relate.snapshot_diff(of(o.where("o_orderdate < timestamp'1997-01-01'")), of(o.where("o_orderdate >= timestamp'1995-01-01'")), ["o_custkey"], ["n", "top"])


WINDOWS = [("1-URGENT", 1993, 1995, "early"), ("1-URGENT", 1995, 1997, "late"), ("2-HIGH", 1994, 1996, "mid"), ("5-LOW", 1992, 1992, "first")]


@query(f"""
WITH w(o_orderpriority, first_year, last_year, rule) AS (VALUES {', '.join(map(str, WINDOWS))})
SELECT o_orderkey, rule FROM orders JOIN w USING (o_orderpriority) WHERE year(o_orderdate) BETWEEN first_year AND last_year""")
def interval_join(spark, sf):
    """Competing windows of one cohort, both ends inclusive; a row may meet several."""
    windows = spark.createDataFrame(WINDOWS, "o_orderpriority string, first_year int, last_year int, rule string")
    facts = load(spark, sf, "orders").select("o_orderkey", "o_orderpriority", F.year("o_orderdate").alias("y"))
    return relate.interval_join(facts, windows, ["o_orderpriority"], "y", "first_year", "last_year").select("o_orderkey", "rule")


@query("""
SELECT f.event_id, v.event_id AS version
FROM (SELECT * FROM events WHERE event_type <> 'purchase') f
ASOF LEFT JOIN (SELECT user_id, ts, max(event_id) AS event_id FROM events WHERE event_type = 'purchase' GROUP BY 1, 2) v ON f.user_id = v.user_id AND f.ts >= v.ts""")
def as_of_visible(spark, sf):
    """The latest purchase of the same user not after each other event."""
    e = load(spark, sf, "events").select("event_id", "user_id", "ts", "event_type")
    versions = e.where("event_type = 'purchase'").groupBy("user_id", "ts").agg(F.max("event_id").alias("version"))
    facts = e.where("event_type <> 'purchase'").select("event_id", "user_id", "ts")
    return relate.as_of(facts, versions, ["user_id"], "ts", "ts", ["version"]).select("event_id", "version")


@query("""
WITH idx AS (SELECT s_nationkey, s_suppkey % 40 AS pocket, count(DISTINCT s_suppkey) AS n, min(s_suppkey) AS m FROM supplier GROUP BY 1, 2)
SELECT c_custkey, CASE WHEN n IS NULL THEN 'absent' WHEN n > 1 THEN 'ambiguous' ELSE 'unique' END AS outcome, CASE WHEN n = 1 THEN m END AS match
FROM customer LEFT JOIN idx ON c_nationkey = s_nationkey AND c_custkey % 40 = pocket""")
def unique_match_join(spark, sf):
    s = load(spark, sf, "supplier").select(F.col("s_nationkey").alias("place"), (F.col("s_suppkey") % 40).alias("pocket"), "s_suppkey")
    c = load(spark, sf, "customer").select("c_custkey", F.col("c_nationkey").alias("place"), (F.col("c_custkey") % 40).alias("pocket"))
    return relate.unique_match(c, s, ["place", "pocket"], "s_suppkey").select("c_custkey", "outcome", "match")


@query("""
SELECT DISTINCT l_orderkey, l_suppkey FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN supplier ON l_suppkey = s_suppkey JOIN customer ON o_custkey = c_custkey
WHERE s_nationkey = c_nationkey OR (o_orderpriority = '1-URGENT' AND s_acctbal > 9000)""")
def composite_proof_join(spark, sf):
    """An OR of two key sets is the union of two equi-joins, each of which can be pruned alone."""
    l, o = load(spark, sf, "lineitem"), load(spark, sf, "orders")
    s, c = load(spark, sf, "supplier"), load(spark, sf, "customer")
    base = l.select("l_orderkey", "l_suppkey").join(o.select("o_orderkey", "o_custkey", "o_orderpriority"), F.col("l_orderkey") == F.col("o_orderkey"))
    same = base.join(s, F.col("l_suppkey") == F.col("s_suppkey")).join(c, (F.col("o_custkey") == F.col("c_custkey")) & (F.col("s_nationkey") == F.col("c_nationkey")))
    custs = c.select("c_custkey")
    urgent = base.where("o_orderpriority = '1-URGENT'").join(s.where("s_acctbal > 9000"), F.col("l_suppkey") == F.col("s_suppkey")).join(custs, F.col("o_custkey") == F.col("c_custkey"))
    return same.select("l_orderkey", "l_suppkey").unionByName(urgent.select("l_orderkey", "l_suppkey")).distinct()


@query("""
SELECT n_name, count(c_custkey) AS customers, coalesce(bool_or(c_acctbal < 0), false) AS has_debt, coalesce(bool_or(c_mktsegment = 'BUILDING'), false) AS has_building
FROM nation LEFT JOIN customer ON n_nationkey = c_nationkey GROUP BY n_name""")
def existence_flags(spark, sf):
    c = load(spark, sf, "customer").groupBy("c_nationkey").agg(F.count("*").alias("customers"), F.bool_or(F.col("c_acctbal") < 0).alias("d"), F.bool_or(F.col("c_mktsegment") == "BUILDING").alias("b"))
    out = load(spark, sf, "nation").join(c, F.col("n_nationkey") == F.col("c_nationkey"), "left")
    return out.select("n_name", F.coalesce("customers", F.lit(0)).alias("customers"), F.coalesce("d", F.lit(False)).alias("has_debt"), F.coalesce("b", F.lit(False)).alias("has_building"))


@query("""
SELECT r_name, s AS o_orderstatus, count(o_orderkey) AS orders
FROM region CROSS JOIN (VALUES ('F'), ('O'), ('P')) t(s)
LEFT JOIN nation ON n_regionkey = r_regionkey LEFT JOIN customer ON c_nationkey = n_nationkey LEFT JOIN orders ON o_custkey = c_custkey AND o_orderstatus = s
GROUP BY ALL""")
def completed_dimensions(spark, sf):
    """Empty groups appear: the groups are counted first, then joined to the (tiny) product of dimensions."""
    o, c, n, r = (load(spark, sf, t) for t in ("orders", "customer", "nation", "region"))
    counts = o.join(c, F.col("o_custkey") == F.col("c_custkey")).join(n, F.col("c_nationkey") == F.col("n_nationkey")).groupBy("n_regionkey", "o_orderstatus").agg(F.count("*").alias("orders"))
    dims = r.select("r_regionkey", "r_name", F.explode(F.array(*map(F.lit, "FOP"))).alias("s"))
    out = dims.join(counts, (F.col("r_regionkey") == F.col("n_regionkey")) & (F.col("s") == F.col("o_orderstatus")), "left")
    return out.select("r_name", F.col("s").alias("o_orderstatus"), F.coalesce("orders", F.lit(0)).alias("orders"))


@query("""
SELECT 'intersect' AS op, count(*) AS n FROM (SELECT c_custkey FROM customer INTERSECT SELECT o_custkey FROM orders)
UNION ALL SELECT 'except', count(*) FROM (SELECT c_custkey FROM customer EXCEPT SELECT o_custkey FROM orders)
UNION ALL SELECT 'union', count(*) FROM (SELECT c_custkey FROM customer UNION SELECT o_custkey FROM orders)
UNION ALL SELECT 'except_all', count(*) FROM (SELECT o_custkey FROM orders EXCEPT ALL SELECT c_custkey FROM customer)""")
def set_ops(spark, sf):
    c, o = load(spark, sf, "customer").select("c_custkey"), load(spark, sf, "orders").select(F.col("o_custkey").alias("c_custkey"))
    n = lambda df, name: df.agg(F.count("*").alias("n")).select(F.lit(name).alias("op"), "n")
    return n(c.intersect(o), "intersect").unionByName(n(c.subtract(o), "except")).unionByName(n(c.union(o).distinct(), "union")).unionByName(n(o.exceptAll(c), "except_all"))


@query("""
WITH a AS (SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem WHERE l_quantity > 10 GROUP BY ALL),
b AS (SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem WHERE l_quantity < 40 GROUP BY ALL)
SELECT coalesce(a.l_orderkey, b.l_orderkey) AS l_orderkey, coalesce(a.l_linenumber, b.l_linenumber) AS l_linenumber,
  greatest(coalesce(a.n, 0) - coalesce(b.n, 0), 0) AS missing, greatest(coalesce(b.n, 0) - coalesce(a.n, 0), 0) AS excess
FROM a FULL JOIN b ON a.l_orderkey = b.l_orderkey AND a.l_linenumber = b.l_linenumber WHERE coalesce(a.n, 0) <> coalesce(b.n, 0)""")
def multiset_diff(spark, sf):
    l = load(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    return relate.multiset_diff(l.where("l_quantity > 10"), l.where("l_quantity < 40"), ["l_orderkey", "l_linenumber"])


@query("""
SELECT o_orderkey FROM orders WHERE o_totalprice > 100000 AND NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_returnflag = 'R')""")
def reported_minus_verified(spark, sf):
    back = load(spark, sf, "lineitem").where("l_returnflag = 'R'").select("l_orderkey")
    return load(spark, sf, "orders").where("o_totalprice > 100000").select("o_orderkey").join(back, F.col("l_orderkey") == F.col("o_orderkey"), "left_anti")


@query("""
WITH v AS (SELECT l_orderkey, sha256(string_agg(CAST(l_linenumber AS VARCHAR), ',' ORDER BY l_linenumber)) AS proof FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem) GROUP BY 1),
p AS (SELECT l_orderkey, CASE WHEN l_orderkey % 7 = 0 THEN 'x' ELSE sha256(string_agg(CAST(l_linenumber AS VARCHAR), ',' ORDER BY l_linenumber)) END AS proof FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem WHERE l_orderkey % 5 <> 0) GROUP BY 1)
SELECT CASE WHEN p.proof IS NULL THEN 'unmatched' WHEN p.proof = v.proof THEN 'verified' ELSE 'tampered' END AS verdict, count(*) AS n
FROM v LEFT JOIN p USING (l_orderkey) GROUP BY 1""")
def verify_reconciliation(spark, sf):
    """Published digests against recomputed ones."""
    lines = load(spark, sf, "lineitem").select("l_orderkey", "l_linenumber").distinct()
    v = lines.groupBy("l_orderkey").agg(F.sha2(F.array_join(F.transform(F.array_sort(F.collect_list("l_linenumber")), lambda x: x.cast("string")), ","), 256).alias("proof"))
    p = v.where("l_orderkey % 5 <> 0").select("l_orderkey", F.when(F.col("l_orderkey") % 7 == 0, "x").otherwise(F.col("proof")).alias("published"))
    verdict = F.when(F.col("published").isNull(), "unmatched").when(F.col("published") == F.col("proof"), "verified").otherwise("tampered")
    return v.join(p, "l_orderkey", "left").groupBy(verdict.alias("verdict")).agg(F.count("*").alias("n"))


@query("""
SELECT l_orderkey, l_linenumber, CAST(l_extendedprice AS DECIMAL(18,2)) = CAST(p_retailprice AS DECIMAL(18,2)) AS same_price, l_quantity IS NOT DISTINCT FROM CAST(p_size AS DOUBLE) AS same_size
FROM lineitem LEFT JOIN part ON l_partkey = p_partkey""")
def verify_roundtrip(spark, sf):
    """Cell by cell against a reference table."""
    out = load(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice", "l_quantity").join(load(spark, sf, "part").select("p_partkey", "p_retailprice", "p_size"), F.col("l_partkey") == F.col("p_partkey"), "left")
    return out.select("l_orderkey", "l_linenumber", (money("l_extendedprice") == money("p_retailprice")).alias("same_price"), F.col("l_quantity").eqNullSafe(F.col("p_size").cast("double")).alias("same_size"))


@query("""
SELECT a.p_partkey AS a, b.p_partkey AS b, a.p_size = b.p_size AS same_size, a.p_brand = b.p_brand AS same_brand
FROM part a JOIN part b ON a.p_type = b.p_type AND a.p_name = b.p_name AND a.p_partkey < b.p_partkey""")
def pair_flags(spark, sf):
    """Pairs within a block (same type and name), flagged by what agrees: every pair, however large its block."""
    return relate.pair_agreements(load(spark, sf, "part"), ["p_type", "p_name"], "p_partkey", {"same_size": "p_size", "same_brand": "p_brand"})


@query("""
SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS day, CASE WHEN o_orderdate > TIMESTAMP '1997-06-30' THEN 'future' WHEN o_orderdate < TIMESTAMP '1993-01-01' THEN 'outside' ELSE 'admitted' END AS class
FROM orders""")
def profile_dates(spark, sf):
    """A declarative profile's date predicate: within the window and not after the as-of day."""
    kind = F.when(F.col("o_orderdate") > F.expr("timestamp'1997-06-30'"), "future").when(F.col("o_orderdate") < F.expr("timestamp'1993-01-01'"), "outside").otherwise("admitted")
    return load(spark, sf, "orders").select("o_orderkey", day("o_orderdate").alias("day"), kind.alias("class"))
