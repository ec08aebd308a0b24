"""Census, coverage, gap, funnel and worksheet reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from factloom.operators import guards
from factloom.plans.registry import query
from factloom.sources.tables import day, load, money


def _placed(spark, sf):
    """customer with nation and region names; narrow."""
    n = load(spark, sf, "nation").join(load(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return load(spark, sf, "customer").join(n, F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", "c_acctbal", "c_mktsegment", "n_name", "r_name")


PLACED = "customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"


@query(f"""
WITH o AS (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1)
SELECT coalesce(r_name, 'TOTAL') AS r_name, count(*) AS customers, count(*) FILTER (WHERE o.n IS NOT NULL) AS with_orders, count(*) FILTER (WHERE c_acctbal < 0) AS in_debt,
  CAST(floor(100 * count(*) FILTER (WHERE o.n IS NOT NULL) / count(*)) AS BIGINT) AS percent_with_orders, CAST(coalesce(sum(o.n), 0) AS BIGINT) AS orders
FROM {PLACED} LEFT JOIN o ON c_custkey = o_custkey GROUP BY ROLLUP (r_name)""")
def region_census(spark, sf):
    """Conditional counts by region with a TOTAL row; orders are pre-aggregated, so the join stays narrow."""
    o = load(spark, sf, "orders").groupBy("o_custkey").agg(F.count("*").alias("n"))
    rows = _placed(spark, sf).join(o, F.col("c_custkey") == F.col("o_custkey"), "left")
    out = rows.rollup("r_name").agg(F.count("*").alias("customers"), F.count_if(F.col("n").isNotNull()).alias("with_orders"), F.count_if(F.col("c_acctbal") < 0).alias("in_debt"), F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("orders"))
    return out.select(F.coalesce("r_name", F.lit("TOTAL")).alias("r_name"), "customers", "with_orders", "in_debt", F.floor(F.try_divide(F.col("with_orders") * 100, F.col("customers"))).cast("long").alias("percent_with_orders"), "orders")


@query("""
WITH u AS (SELECT user_id, bool_or(event_type = 'click') AS c, bool_or(event_type = 'purchase') AS p FROM events GROUP BY 1)
SELECT CASE WHEN c AND p THEN 'multi' WHEN c THEN 'click_only' WHEN p THEN 'purchase_only' ELSE 'none' END AS kind, count(*) AS users FROM u GROUP BY 1""")
def activity_breakdown(spark, sf):
    u = load(spark, sf, "events").groupBy("user_id").agg(F.bool_or(F.col("event_type") == "click").alias("c"), F.bool_or(F.col("event_type") == "purchase").alias("p"))
    kind = F.when(F.col("c") & F.col("p"), "multi").when(F.col("c"), "click_only").when(F.col("p"), "purchase_only").otherwise("none")
    return u.groupBy(kind.alias("kind")).agg(F.count("*").alias("users"))


GAPS = {
    "no_orders": "coalesce(n, 0) = 0",
    "no_urgent": "coalesce(urgent, 0) = 0",
    "no_high": "coalesce(high, 0) = 0",
    "only_pending": "n > 0 AND pending = n",
    "no_finished": "n > 0 AND finished = 0",
    "stale": "last < TIMESTAMP '2000-01-01 00:00:00'",
    "single_order": "n = 1",
    "low_total": "total < 100000",
    "in_debt": "c_acctbal < 0",
    "no_segment": "c_mktsegment IS NULL",
    "no_balance": "c_acctbal IS NULL",
}


@query(f"""
WITH o AS (SELECT o_custkey, count(*) AS n, count(*) FILTER (WHERE o_orderpriority = '1-URGENT') AS urgent, count(*) FILTER (WHERE o_orderpriority = '2-HIGH') AS high, count(*) FILTER (WHERE o_orderstatus = 'P') AS pending, count(*) FILTER (WHERE o_orderstatus = 'F') AS finished, max(o_orderdate) AS last, sum(CAST(o_totalprice AS DECIMAL(18,2))) AS total FROM orders GROUP BY 1),
w AS (SELECT n_name, {', '.join(f'count(*) FILTER (WHERE {g}) AS {k}' for k, g in GAPS.items())} FROM {PLACED} LEFT JOIN o ON c_custkey = o_custkey GROUP BY 1)
SELECT n_name, gap, n FROM w UNPIVOT (n FOR gap IN ({', '.join(GAPS)})) WHERE n > 0""")
def gap_report(spark, sf):
    """Eleven gap classes by nation as rows; zero rows are left out."""
    is_ = lambda c, v: F.count_if(F.col(c) == v)
    o = load(spark, sf, "orders").groupBy("o_custkey").agg(F.count("*").alias("n"), is_("o_orderpriority", "1-URGENT").alias("urgent"), is_("o_orderpriority", "2-HIGH").alias("high"), is_("o_orderstatus", "P").alias("pending"), is_("o_orderstatus", "F").alias("finished"), F.max("o_orderdate").alias("last"), F.sum(money("o_totalprice")).alias("total"))
    rows = _placed(spark, sf).join(o, F.col("c_custkey") == F.col("o_custkey"), "left")
    wide = rows.groupBy("n_name").agg(*[F.count_if(F.expr(g)).alias(k) for k, g in GAPS.items()])
    return wide.unpivot("n_name", list(GAPS), "gap", "n").where("n > 0")


STAGES = {
    "registered": "true",
    "timed": "ts IS NOT NULL",
    "named": "ts IS NOT NULL AND user_id IS NOT NULL",
    "typed": "ts IS NOT NULL AND user_id IS NOT NULL AND event_type IS NOT NULL",
    "attempted": "event_type <> 'error'",
    "valued": "event_type <> 'error' AND value IS NOT NULL",
    "captured": "event_type IN ('click', 'purchase') AND value IS NOT NULL",
    "accepted": "event_type = 'purchase' AND value IS NOT NULL",
    "weighty": "event_type = 'purchase' AND value >= 5",
    "settled": "event_type = 'purchase' AND value >= 10",
}


@query(f"""
WITH f AS (SELECT user_id, {', '.join(f'count(*) FILTER (WHERE {c}) AS {k}' for k, c in STAGES.items())} FROM events GROUP BY 1)
SELECT *, {' AND '.join(f'{a} >= {b}' for a, b in zip(STAGES, list(STAGES)[1:], strict=False))} AS monotone FROM f""")
def contact_funnel(spark, sf):
    """A funnel of ten counters a subject, each at most the one before."""
    e = load(spark, sf, "events").groupBy("user_id").agg(*[F.count_if(F.expr(c)).alias(k) for k, c in STAGES.items()])
    return guards.monotone(e, list(STAGES))


CENSUS = {
    **{f"status_{s.lower()}": f"o_orderstatus = '{s}'" for s in "FOP"},
    **{f"priority_{p[0]}": f"o_orderpriority = '{p}'" for p in ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")},
    **{f"year_{y}": f"year(o_orderdate) = {y}" for y in range(1995, 2002)},
    **{f"price_from_{n}k": f"o_totalprice >= {n}000" for n in (50, 100, 200, 300)},
    **{f"segment_{s.lower()}": f"c_mktsegment = '{s}'" for s in ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")},
    "in_debt": "c_acctbal < 0",
    "in_credit": "c_acctbal >= 0",
    "urgent_open": "o_orderpriority = '1-URGENT' AND o_orderstatus <> 'F'",
    "no_price": "o_totalprice IS NULL",
    "no_date": "o_orderdate IS NULL",
    "no_order": "o_orderkey IS NULL",
}


@query(f"""
SELECT coalesce(n_name, 'TOTAL') AS place, count(*) AS n_rows, {', '.join(f'count(*) FILTER (WHERE {c}) AS {k}' for k, c in CENSUS.items())}
FROM {PLACED} LEFT JOIN orders ON c_custkey = o_custkey GROUP BY ROLLUP (n_name)""")
def wide_census(spark, sf):
    """A state census: thirty conditional counters a nation and their total row, in one aggregate."""
    o = load(spark, sf, "orders")
    rows = _placed(spark, sf).join(o, F.col("c_custkey") == F.col("o_custkey"), "left")
    out = rows.rollup("n_name").agg(F.count("*").alias("n_rows"), *[F.count_if(F.expr(c)).alias(k) for k, c in CENSUS.items()])
    return out.withColumn("place", F.coalesce("n_name", F.lit("TOTAL"))).drop("n_name")


@query("""
WITH f AS (SELECT user_id, count(*) AS registered, count(*) FILTER (WHERE event_type <> 'error') AS attempted, count(*) FILTER (WHERE event_type IN ('click', 'purchase')) AS captured, count(*) FILTER (WHERE event_type = 'purchase') AS accepted FROM events GROUP BY 1)
SELECT *, registered >= attempted AND attempted >= captured AND captured >= accepted AS monotone FROM f""")
def funnel_check(spark, sf):
    of = lambda c: F.count_if(c)
    e = load(spark, sf, "events").groupBy("user_id").agg(F.count("*").alias("registered"), of(F.col("event_type") != "error").alias("attempted"), of(F.col("event_type").isin("click", "purchase")).alias("captured"), of(F.col("event_type") == "purchase").alias("accepted"))
    return guards.monotone(e, ["registered", "attempted", "captured", "accepted"])


@query("""
SELECT o_custkey, CASE WHEN count(CASE WHEN o_orderstatus <> 'P' THEN o_totalprice END) = count(*) THEN CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) END AS complete_total, count(*) AS n
FROM orders GROUP BY 1""")
def null_if_incomplete(spark, sf):
    """A customer's total only where every order declares the stage."""
    declared = F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice"))
    total = F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double")
    return load(spark, sf, "orders").groupBy("o_custkey").agg(F.when(F.count(declared) == F.count("*"), total).alias("complete_total"), F.count("*").alias("n"))


@query("SELECT source, string_agg(lang || '=' || n, ',' ORDER BY lang) AS histogram, CAST(sum(n) AS BIGINT) AS documents FROM (SELECT coalesce(source, '?') AS source, coalesce(lang, '?') AS lang, count(*) AS n FROM documents GROUP BY ALL) GROUP BY 1")
def histogram_map(spark, sf):
    """Counts by language within a source, as a map rendered in key order."""
    c = load(spark, sf, "documents").groupBy(F.coalesce("source", F.lit("?")).alias("source"), F.coalesce("lang", F.lit("?")).alias("lang")).agg(F.count("*").alias("n"))
    parts = F.transform(F.array_sort(F.collect_list(F.struct("lang", "n"))), lambda x: F.concat(x["lang"], F.lit("="), x["n"].cast("string")))
    return c.groupBy("source").agg(F.array_join(parts, ",").alias("histogram"), F.sum("n").alias("documents"))


@query("SELECT p_type, p_name, count(*) AS n, min(p_partkey) AS first_key FROM part GROUP BY 1, 2 HAVING count(*) > 1")
def duplicate_groups(spark, sf):
    return load(spark, sf, "part").groupBy("p_type", "p_name").agg(F.count("*").alias("n"), F.min("p_partkey").alias("first_key")).where("n > 1")


@query("SELECT event_type, count(*) AS events, count(DISTINCT user_id) AS users, strftime(min(ts), '%Y-%m-%d') AS first_day, strftime(max(ts), '%Y-%m-%d') AS last_day FROM events GROUP BY 1")
def source_coverage(spark, sf):
    e = load(spark, sf, "events").groupBy("event_type").agg(F.count("*").alias("events"), F.count_distinct("user_id").alias("users"), F.min("ts").alias("a"), F.max("ts").alias("b"))
    return e.select("event_type", "events", "users", day("a").alias("first_day"), day("b").alias("last_day"))


@query("""
WITH t AS (SELECT c_custkey, count(o_orderkey) AS n, count(*) FILTER (WHERE o_orderstatus = 'F') AS f FROM customer LEFT JOIN orders ON c_custkey = o_custkey GROUP BY 1)
SELECT CASE WHEN n = 0 THEN 'unresearched' WHEN f = 0 THEN 'pending' WHEN f < n THEN 'retained_gap' ELSE 'complete' END AS state, count(*) AS customers FROM t GROUP BY 1""")
def coverage_states(spark, sf):
    """Nothing attempted, pending, a retained gap, or complete."""
    o = load(spark, sf, "orders").groupBy("o_custkey").agg(F.count("*").alias("n"), F.count_if(F.col("o_orderstatus") == "F").alias("f"))
    t = load(spark, sf, "customer").select("c_custkey").join(o, F.col("c_custkey") == F.col("o_custkey"), "left")
    state = F.when(F.col("n").isNull(), "unresearched").when(F.col("f") == 0, "pending").when(F.col("f") < F.col("n"), "retained_gap").otherwise("complete")
    return t.groupBy(state.alias("state")).agg(F.count("*").alias("customers"))


@query("""
SELECT user_id, string_agg(event_type || ' x' || n, chr(10) ORDER BY event_type) AS cell, CAST(sum(n) AS BIGINT) AS events
FROM (SELECT user_id, event_type, count(*) AS n FROM events GROUP BY ALL) GROUP BY 1""")
def list_cell_worksheet(spark, sf):
    """One row a subject, its values gathered into a wrapped list cell."""
    c = load(spark, sf, "events").groupBy("user_id", "event_type").agg(F.count("*").alias("n"))
    line = F.concat("event_type", F.lit(" x"), F.col("n").cast("string"))
    return c.groupBy("user_id").agg(F.array_join(F.array_sort(F.collect_list(line)), "\n").alias("cell"), F.sum("n").alias("events"))


STATUSES = ["F", "O", "P"]


@query(f"""
SELECT o_custkey, {', '.join(f"count(*) FILTER (WHERE o_orderstatus = '{t}') AS status_{t.lower()}" for t in STATUSES)} FROM orders GROUP BY 1""")
def pivot_worksheet(spark, sf):
    o = load(spark, sf, "orders").groupBy("o_custkey").pivot("o_orderstatus", STATUSES).agg(F.count(F.lit(1)))
    return o.select("o_custkey", *[F.coalesce(F.col(t), F.lit(0)).alias(f"status_{t.lower()}") for t in STATUSES])


@query("""
SELECT user_id, count(*) FILTER (WHERE event_type NOT IN ('purchase', 'error')) AS open_stages, count(*) FILTER (WHERE event_type = 'purchase' AND value < 1) AS silent, count(DISTINCT CASE WHEN event_type = 'view' THEN strftime(ts, '%Y-%m-%d') END) AS days
FROM events GROUP BY 1""")
def open_work(spark, sf):
    e = load(spark, sf, "events")
    return e.groupBy("user_id").agg(F.count_if(~F.col("event_type").isin("purchase", "error")).alias("open_stages"), F.count_if((F.col("event_type") == "purchase") & (F.col("value") < 1)).alias("silent"), F.count_distinct(F.when(F.col("event_type") == "view", day("ts"))).alias("days"))


@query("""
SELECT c_custkey, CASE WHEN bool_or(o_orderpriority = '1-URGENT') THEN 1 ELSE 0 END + CASE WHEN bool_or(o_orderstatus = 'P') THEN 2 ELSE 0 END + CASE WHEN min(year(o_orderdate)) < 1993 THEN 4 ELSE 0 END + CASE WHEN count(o_orderkey) = 0 THEN 8 ELSE 0 END AS reasons
FROM customer LEFT JOIN orders ON c_custkey = o_custkey GROUP BY 1""")
def participation_reasons(spark, sf):
    """A mask of reason bits, combined over a subject's rows by bit_or."""
    o = load(spark, sf, "orders")
    bits = F.when(F.col("o_orderpriority") == "1-URGENT", 1).otherwise(0).bitwiseOR(F.when(F.col("o_orderstatus") == "P", 2).otherwise(0)).bitwiseOR(F.when(F.year("o_orderdate") < 1993, 4).otherwise(0))
    mask = o.groupBy("o_custkey").agg(F.bit_or(bits).alias("mask"))
    return load(spark, sf, "customer").select("c_custkey").join(mask, F.col("c_custkey") == F.col("o_custkey"), "left").select("c_custkey", F.coalesce("mask", F.lit(8)).alias("reasons"))


@query("""
SELECT o_custkey, bool_or(year(o_orderdate) = 1997) AS is_current, bool_or(year(o_orderdate) < 1997) AS is_former,
  CASE WHEN bool_or(year(o_orderdate) = 1997) AND bool_or(year(o_orderdate) < 1997) THEN 'conflict' WHEN bool_or(year(o_orderdate) = 1997) THEN 'current' WHEN bool_or(year(o_orderdate) < 1997) THEN 'former' ELSE 'unknown' END AS tenure,
  max(CASE WHEN year(o_orderdate) < 1997 THEN year(o_orderdate) END) AS last_year
FROM orders GROUP BY 1""")
def tenure_assessment(spark, sf):
    y = F.year("o_orderdate")
    o = load(spark, sf, "orders").groupBy("o_custkey").agg(F.bool_or(y == 1997).alias("is_current"), F.bool_or(y < 1997).alias("is_former"), F.max(F.when(y < 1997, y)).alias("last_year"))
    tenure = F.when(F.col("is_current") & F.col("is_former"), "conflict").when(F.col("is_current"), "current").when(F.col("is_former"), "former").otherwise("unknown")
    return o.select("o_custkey", "is_current", "is_former", tenure.alias("tenure"), "last_year")


@query("""
SELECT o_orderkey, CASE WHEN o_totalprice > 50000 THEN 'eligible' ELSE 'excluded' END AS disposition,
  concat_ws(',', CASE WHEN o_totalprice <= 50000 THEN 'price' END, CASE WHEN o_totalprice <= 50000 AND o_orderstatus = 'P' THEN 'status' END) AS reasons
FROM orders""")
def exclusion_audit(spark, sf):
    """Every candidate is eligible or excluded, never both, with sorted reasons."""
    out = F.col("o_totalprice") <= 50000
    return load(spark, sf, "orders").select("o_orderkey", F.when(~out, "eligible").otherwise("excluded").alias("disposition"), F.concat_ws(",", F.when(out, "price"), F.when(out & (F.col("o_orderstatus") == "P"), "status")).alias("reasons"))


@query("""
WITH m AS (SELECT user_id, string_agg(DISTINCT event_type, ',' ORDER BY event_type) AS types, count(DISTINCT event_type) AS n, bool_or(event_type = 'error') AS failed FROM events GROUP BY 1)
SELECT user_id, types, CASE WHEN failed THEN 'terminal' WHEN n >= 4 THEN 'complete' ELSE 'partial' END AS completion FROM m""")
def combined_completeness(spark, sf):
    """All components needed; a terminal one decides."""
    m = load(spark, sf, "events").groupBy("user_id").agg(F.array_sort(F.collect_set("event_type")).alias("t"))
    completion = F.when(F.exists("t", lambda x: x == "error"), "terminal").when(F.size("t") >= 4, "complete").otherwise("partial")
    return m.select("user_id", F.array_join("t", ",").alias("types"), completion.alias("completion"))


@query("""
SELECT o_orderkey, o_orderpriority, CASE WHEN n = 2 AND a = b THEN 'agreed' WHEN n < 2 THEN 'open' ELSE 'split' END AS consensus FROM (
  SELECT o_orderkey, o_orderpriority, least(count(DISTINCT l_suppkey), 2) AS n, min(l_returnflag) AS a, max(l_returnflag) AS b FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY ALL)""")
def dual_consensus(spark, sf):
    """Two independent lanes (suppliers) must give one answer (the return flag)."""
    l = load(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.min("l_suppkey").alias("s0"), F.max("l_suppkey").alias("s1"), F.min("l_returnflag").alias("a"), F.max("l_returnflag").alias("b"))
    state = F.when(F.col("s0") == F.col("s1"), "open").when(F.col("a") == F.col("b"), "agreed").otherwise("split")
    return load(spark, sf, "orders").select("o_orderkey", "o_orderpriority").join(l, F.col("o_orderkey") == F.col("l_orderkey")).select("o_orderkey", "o_orderpriority", state.alias("consensus"))


@query("""
SELECT o.o_orderkey, coalesce(s.state, 'new') AS state FROM (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'F') o
LEFT JOIN (SELECT o_orderkey, 'decided' AS state FROM orders WHERE o_totalprice > 200000) s USING (o_orderkey)""")
def case_carry_over(spark, sf):
    """Cases minted anew keep the state that was stored for them."""
    o = load(spark, sf, "orders")
    stored = o.where("o_totalprice > 200000").select("o_orderkey", F.lit("decided").alias("state"))
    return o.where("o_orderstatus <> 'F'").select("o_orderkey").join(stored, "o_orderkey", "left").select("o_orderkey", F.coalesce("state", F.lit("new")).alias("state"))


@query("""
SELECT c_custkey, arg_min(o_orderkey, ROW(o_orderpriority, -o_totalprice, o_orderkey)) AS head, count(*) AS claims, CASE WHEN count(DISTINCT o_orderpriority) > 1 THEN 'ranked' ELSE 'single_class' END AS state
FROM customer JOIN orders ON c_custkey = o_custkey GROUP BY 1""")
def contact_head(spark, sf):
    """The head of ranked claims: class first, then weight, then id."""
    o = load(spark, sf, "orders")
    rank = F.struct("o_orderpriority", (-F.col("o_totalprice")).alias("v"), "o_orderkey")
    out = o.groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.min_by("o_orderkey", rank).alias("head"), F.count("*").alias("claims"), F.min("o_orderpriority").alias("a"), F.max("o_orderpriority").alias("b"))
    return out.join(load(spark, sf, "customer").select("c_custkey"), "c_custkey", "left_semi").select("c_custkey", "head", "claims", F.when(F.col("a") != F.col("b"), "ranked").otherwise("single_class").alias("state"))
