"""Streaming queries; where the batch equivalent is SQL, it is the twin."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from factloom.operators.durable import shared_dir
from factloom.plans.registry import query
from factloom.sources.sinks import Store
from factloom.streaming import events as E


@query("SELECT strftime(date_trunc('day', ts), '%Y-%m-%d %H:%M') AS start, event_type, count(*) AS n FROM events GROUP BY ALL")
def tumbling_windows(spark, sf):
    return E.run_to_table(E.tumbling(E.read_events(spark, sf)))


@query("""
SELECT strftime(s, '%Y-%m-%d %H:%M') AS start, count(*) AS n FROM (SELECT unnest([date_trunc('day', ts), date_trunc('day', ts) - INTERVAL 1 DAY]) AS s FROM events) GROUP BY ALL""")
def sliding_windows(spark, sf):
    return E.run_to_table(E.sliding(E.read_events(spark, sf)))


@query("""
WITH g AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) < INTERVAL 6 HOUR THEN 0 ELSE 1 END AS fresh FROM events),
s AS (SELECT user_id, ts, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS k FROM g)
SELECT user_id, strftime(min(ts), '%Y-%m-%d %H:%M:%S') AS start, count(*) AS n FROM s GROUP BY user_id, k""")
def session_windows(spark, sf):
    return E.run_to_table(E.sessions(E.read_events(spark, sf)))


@query("SELECT event_type, count(*) AS n, count(DISTINCT event_id) AS events FROM events GROUP BY 1")
def idempotent_ingest(spark, sf):
    """The stream is ingested, resumed, and delivered whole again; receipts make that a repeat."""
    store = Store(spark, f"{shared_dir(spark)}/ingest-{uuid.uuid4().hex}")
    for _ in range(2):
        E.ingest(E.read_events(spark, sf), store, "observations")
    E.run_to_table(E.read_events(spark, sf), "append", lambda df, batch: store.commit_once("observations", None, df))
    return store.committed("observations").groupBy("event_type").agg(F.count("*").alias("n"), F.count_distinct("event_id").alias("events"))


@query("SELECT event_type, count(*) AS n FROM events GROUP BY 1")
def observation_credit(spark, sf):
    """Every event is delivered twice and counted once."""
    stream = E.read_events(spark, sf)
    twice = stream.withColumn("delivery", F.explode(F.array(F.lit(1), F.lit(2))))
    once = E.run_to_table(E.credited_once(twice).select("event_id", "event_type"), "append")
    return once.groupBy("event_type").agg(F.count("*").alias("n"))


@query("SELECT user_id, count(*) AS n FROM events GROUP BY 1")
def stateful_counts(spark, sf):
    """The last emitted state of each user."""
    updates = E.run_to_table(E.running_counts(E.read_events(spark, sf).select("user_id", "event_id")), "update")
    return updates.groupBy("user_id").agg(F.max("n").alias("n"))


@query("SELECT CASE WHEN ts > TIMESTAMP '2024-01-20 00:00:00' THEN 'future' ELSE 'admitted' END AS intake, count(*) AS n FROM events GROUP BY 1")
def late_routing(spark, sf):
    routed = E.run_to_table(E.route_late(E.read_events(spark, sf), "2024-01-20 00:00:00").select("event_id", "intake"), "append")
    return routed.groupBy("intake").agg(F.count("*").alias("n"))


@query("SELECT o_orderstatus, o_orderkey FROM orders WHERE o_totalprice > 150000")
def generation_publish(spark, sf):
    """Two generations are published; readers see the second."""
    store = Store(spark, f"{shared_dir(spark)}/store-{uuid.uuid4().hex}")
    orders = spark.read.parquet(f"{sf}/orders.parquet").select("o_orderstatus", "o_orderkey", "o_totalprice")
    store.publish("orders", orders)
    store.publish("orders", orders.where("o_totalprice > 150000"))
    store.reclaim("orders")
    return store.read("orders").select("o_orderstatus", "o_orderkey")


@query("SELECT event_id, row_number() OVER (ORDER BY event_id) - 1 AS seq FROM events")
def sequence_assignment(spark, sf):
    """Consecutive sequences over two appends."""
    store = Store(spark, f"{shared_dir(spark)}/log-{uuid.uuid4().hex}")
    e = spark.read.parquet(f"{sf}/events.parquet").select("event_id")
    half = e.agg(F.floor(F.median("event_id")).cast("long")).first()[0]
    store.append("events", e.where(F.col("event_id") <= half), [F.col("event_id")])
    store.append("events", e.where(F.col("event_id") > half), [F.col("event_id")])
    return spark.read.parquet(f"{store.root}/events/log").select("event_id", "seq")
