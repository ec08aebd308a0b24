"""Queries that merge observation logs and walk tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from factloom.operators import merge
from factloom.plans.registry import query
from factloom.sources.tables import NAMES, day, load, money

LINE = ["l_orderkey", "l_linenumber"]
#: lineitem has no sequence column: every column takes part, so the order is total.
ORDER = ["l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus"]
SQL_ORDER = "ROW(l_shipdate, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus)"


@query(f"""
SELECT l_orderkey, l_linenumber, count(*) AS observations,
  arg_min(l_partkey, {SQL_ORDER}) AS l_partkey, arg_min(l_returnflag, {SQL_ORDER}) AS l_returnflag,
  max(l_quantity) AS l_quantity, min(l_extendedprice) AS l_extendedprice,
  string_agg(DISTINCT CAST(l_suppkey AS VARCHAR), ',' ORDER BY CAST(l_suppkey AS VARCHAR)) AS l_suppkey,
  min(l_partkey) <> max(l_partkey) AS l_partkey_conflict, min(l_returnflag) <> max(l_returnflag) AS l_returnflag_conflict,
  concat_ws(',', CASE WHEN min(l_partkey) <> max(l_partkey) THEN 'l_partkey' END, CASE WHEN min(l_returnflag) <> max(l_returnflag) THEN 'l_returnflag' END) AS conflicts
FROM lineitem GROUP BY ALL""")
def scan_merge_lineitem(spark, sf):
    rules = {"l_partkey": "first", "l_returnflag": "first", "l_quantity": "max", "l_extendedprice": "min", "l_suppkey": "union"}
    return merge.merge_observations(load(spark, sf, "lineitem"), LINE, ORDER, rules)


@query(f"""
WITH held AS (SELECT l_orderkey, l_linenumber, arg_min(l_partkey, {SQL_ORDER}) AS h FROM lineitem GROUP BY ALL)
SELECT l_orderkey, l_linenumber, min(h) AS l_partkey,
  string_agg(DISTINCT CAST(l_suppkey AS VARCHAR), ',' ORDER BY CAST(l_suppkey AS VARCHAR)) AS evidence,
  count(*) FILTER (WHERE l_partkey <> h) AS dropped
FROM lineitem JOIN held USING (l_orderkey, l_linenumber) GROUP BY l_orderkey, l_linenumber""")
def fold_contradictions(spark, sf):
    return merge.fold_in_order(load(spark, sf, "lineitem"), LINE, ORDER, "l_partkey", "l_suppkey")


@query("SELECT user_id, arg_max(event_type, ROW(ts, event_id)) AS event_type, arg_max(event_id, ROW(ts, event_id)) AS event_id FROM events GROUP BY user_id")
def merge_last_writer(spark, sf):
    return merge.last_writer(load(spark, sf, "events"), ["user_id"], ["ts", "event_id"], ["event_type", "event_id"])


@query("SELECT user_id, arg_min(event_type, ROW(ts, event_id)) AS event_type, arg_min(event_id, ROW(ts, event_id)) AS event_id FROM events GROUP BY user_id")
def merge_first_writer(spark, sf):
    return merge.first_writer(load(spark, sf, "events"), ["user_id"], ["ts", "event_id"], ["event_type", "event_id"])


@query("""
SELECT user_id, arg_max(event_type, ROW(CAST(event_type = 'purchase' AS INT), ts, event_id)) AS event_type,
  arg_max(event_id, ROW(CAST(event_type = 'purchase' AS INT), ts, event_id)) AS event_id
FROM events GROUP BY user_id""")
def merge_sticky_state(spark, sf):
    return merge.sticky(load(spark, sf, "events"), ["user_id"], ["ts", "event_id"], F.col("event_type") == "purchase", ["event_type", "event_id"])


@query("""
SELECT user_id, count(*) AS observations, arg_max(event_type, ROW(ts, event_id)) AS event_type, max(value) AS value, min(event_id) AS event_id
FROM events GROUP BY user_id""")
def merge_access_condition(spark, sf):
    """The later observation wins, limits take their maximum."""
    return merge.merge_observations(load(spark, sf, "events"), ["user_id"], ["ts", "event_id"], {"event_type": "last", "value": "max", "event_id": "min"})


@query("""
SELECT l_orderkey, l_linenumber, field, n_values, low, high FROM (
  SELECT l_orderkey, l_linenumber, 'l_partkey' AS field, count(DISTINCT l_partkey) AS n_values, CAST(min(l_partkey) AS VARCHAR) AS low, CAST(max(l_partkey) AS VARCHAR) AS high FROM lineitem GROUP BY ALL
  UNION ALL
  SELECT l_orderkey, l_linenumber, 'l_returnflag', count(DISTINCT l_returnflag), min(l_returnflag), max(l_returnflag) FROM lineitem GROUP BY ALL
  UNION ALL
  SELECT l_orderkey, l_linenumber, 'l_linestatus', count(DISTINCT l_linestatus), min(l_linestatus), max(l_linestatus) FROM lineitem GROUP BY ALL)
WHERE n_values > 1""")
def conflict_report(spark, sf):
    return merge.conflict_report(load(spark, sf, "lineitem"), LINE, ["l_partkey", "l_returnflag", "l_linestatus"])


@query("SELECT l_orderkey, count(DISTINCT l_linenumber) AS lines, count(*) AS n_rows FROM lineitem WHERE l_orderkey = 7 GROUP BY l_orderkey")
def point_lookup(spark, sf):
    """The filter on the group key reaches the scan, before the merge."""
    return load(spark, sf, "lineitem").where("l_orderkey = 7").groupBy("l_orderkey").agg(F.count_distinct("l_linenumber").alias("lines"), F.count("*").alias("n_rows"))


@query("SELECT o_orderkey, o_custkey, o_orderstatus FROM orders WHERE o_orderkey > 100 ORDER BY o_orderkey LIMIT 50")
def keyset_page(spark, sf):
    """A page of 50 keys after a cursor (the limit is the feature)."""
    return load(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus").where("o_orderkey > 100").orderBy("o_orderkey").limit(50)


IDS = {"region": ["r_regionkey"], "nation": ["n_nationkey"], "customer": ["c_custkey"], "supplier": ["s_suppkey"], "part": ["p_partkey"], "orders": ["o_orderkey"], "lineitem": LINE, "events": ["event_id"], "documents": ["doc_id"], "pages": ["page_id"], "conversations": ["conv_id", "turn"], "benchmark": ["item_id"], "embeddings": ["vec_id"], "labels": ["doc_id"]}


def _walk_sql(name: str) -> str:
    ids = IDS[name]
    d = ids[0] if len(ids) == 1 else f"({', '.join(ids)})"
    return f"SELECT '{name}' AS table_name, count(*) AS n_rows, count(DISTINCT {d}) AS n_ids, count(*) - count(DISTINCT {d}) AS repeats FROM {name}"


@query(" UNION ALL ".join(_walk_sql(n) for n in NAMES))
def walk_table_stats(spark, sf):
    parts = [merge.walk(load(spark, sf, n).select(*IDS[n]), n, IDS[n]) for n in NAMES]
    return reduce(lambda a, b: a.unionByName(b), parts)


@query("SELECT event_type, max(event_id) AS last_sequence, count(*) AS appended FROM events GROUP BY event_type")
def last_sequences(spark, sf):
    return load(spark, sf, "events").groupBy("event_type").agg(F.max("event_id").alias("last_sequence"), F.count("*").alias("appended"))


@query("SELECT event_id, user_id, event_type, strftime(ts, '%Y-%m-%d') AS day FROM events WHERE event_type = 'error'")
def journal_phase(spark, sf):
    """One phase of a journal, by key."""
    return load(spark, sf, "events").where("event_type = 'error'").select("event_id", "user_id", "event_type", day("ts").alias("day")).orderBy("event_id")


@query("""
SELECT l_orderkey, l_linenumber FROM lineitem GROUP BY ALL
HAVING count(DISTINCT (l_partkey, l_suppkey)) = 1 AND count(*) > 1""")
def identity_consistency(spark, sf):
    """Repeated ids whose context is the same everywhere; min = max of a struct needs no distinct."""
    pair = F.struct("l_partkey", "l_suppkey")
    return load(spark, sf, "lineitem").groupBy(*LINE).agg(F.min(pair).alias("a"), F.max(pair).alias("b"), F.count("*").alias("n")).where("a = b and n > 1").select(*LINE)


@query("""
SELECT o_orderpriority, o_orderstatus, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total,
  strftime(min(o_orderdate), '%Y-%m-%d') AS first_day, strftime(max(o_orderdate), '%Y-%m-%d') AS last_day
FROM orders GROUP BY ALL""")
def run_aggregation(spark, sf):
    """Runs of one group summed over its parts."""
    o = load(spark, sf, "orders")
    out = o.groupBy("o_orderpriority", "o_orderstatus").agg(F.sum(money("o_totalprice")).cast("double").alias("total"), F.min("o_orderdate").alias("a"), F.max("o_orderdate").alias("b"))
    return out.select("o_orderpriority", "o_orderstatus", "total", day("a").alias("first_day"), day("b").alias("last_day"))


@query("""
WITH k AS (SELECT event_id, user_id, event_type, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS rn,
  CASE WHEN value < 0 THEN 'negative' WHEN event_type = 'error' THEN 'error' END AS reason FROM events)
SELECT event_id, user_id, event_type, coalesce(reason, CASE WHEN rn > 1 THEN 'superseded' ELSE 'kept' END) AS verdict FROM k""")
def judged_merge(spark, sf):
    """Fragments judged by rules; of the accepted ones of a key the newest stays."""
    from pyspark.sql import Window as W

    newest = F.row_number().over(W.partitionBy("user_id", "event_type").orderBy(F.col("ts").desc(), F.col("event_id").desc()))
    reason = F.when(F.col("value") < 0, "negative").when(F.col("event_type") == "error", "error")
    e = load(spark, sf, "events").withColumn("rn", newest)
    return e.select("event_id", "user_id", "event_type", F.coalesce(reason, F.when(F.col("rn") > 1, "superseded").otherwise("kept")).alias("verdict"))
