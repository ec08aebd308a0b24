"""Structured Streaming over observation files: windows, sessions, late data, exactly-once ingest."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from factloom.operators.durable import delete_at_exit, shared_dir
from factloom.sources.sinks import Store

SCHEMA = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"


def read_events(spark: SparkSession, sf_dir: str, per_trigger: int = 1) -> DataFrame:
    """The events table as a file stream, with event time as a timestamp."""
    static = spark.read.parquet(f"{sf_dir}/events.parquet")
    stream = spark.readStream.schema(static.schema).option("maxFilesPerTrigger", per_trigger).option("pathGlobFilter", "*.parquet").parquet(f"{sf_dir}/events.parquet*")
    return stream.withColumn("ts", F.col("ts").cast("timestamp"))


def tumbling(events: DataFrame, width: str = "1 day", late: str = "1 day") -> DataFrame:
    w = events.withWatermark("ts", late).groupBy(F.window("ts", width).alias("w"), "event_type").agg(F.count("*").alias("n"))
    return w.select(F.date_format("w.start", "yyyy-MM-dd HH:mm").alias("start"), "event_type", "n")


def sliding(events: DataFrame, width: str = "2 days", step: str = "1 day", late: str = "1 day") -> DataFrame:
    w = events.withWatermark("ts", late).groupBy(F.window("ts", width, step).alias("w")).agg(F.count("*").alias("n"))
    return w.select(F.date_format("w.start", "yyyy-MM-dd HH:mm").alias("start"), "n")


def sessions(events: DataFrame, gap: str = "6 hours", late: str = "1 day") -> DataFrame:
    w = events.withWatermark("ts", late).groupBy(F.session_window("ts", gap).alias("w"), "user_id").agg(F.count("*").alias("n"))
    return w.select("user_id", F.date_format("w.start", "yyyy-MM-dd HH:mm:ss").alias("start"), "n")


def credited_once(events: DataFrame, late: str = "1 day") -> DataFrame:
    """Each event counts once, however often it is delivered within the watermark."""
    return events.withWatermark("ts", late).dropDuplicatesWithinWatermark(["event_id"])


def running_counts(events: DataFrame) -> DataFrame:
    """A keyed state: each user's number of events so far, emitted whenever it changes (update mode)."""
    return events.groupBy("user_id").agg(F.count("*").alias("n"))


def run_to_table(stream: DataFrame, mode: str = "complete", sink: Callable[[DataFrame, int], None] | None = None, state: str | None = None) -> DataFrame | None:
    """Run all available input; with sink, each micro-batch goes to it, else the result is a table read back.

    State and output live in the shared folder, so a lost executor's tasks start again elsewhere. With state, a
    folder that stays, a later run goes on where the last one stopped.
    """
    spark = stream.sparkSession
    base = f"{shared_dir(spark)}/stream-{uuid.uuid4().hex}"

    def write(df: DataFrame, batch: int) -> None:
        if sink:
            sink(df, batch)
        else:
            df.write.mode("overwrite" if mode == "complete" else "append").parquet(f"{base}/out")

    stream.writeStream.outputMode(mode).option("checkpointLocation", state or f"{base}/state").trigger(availableNow=True).foreachBatch(write).start().awaitTermination()
    if not state:
        delete_at_exit(spark, base)
    return None if sink else spark.read.schema(stream.schema).parquet(f"{base}/out")


def ingest(stream: DataFrame, store: Store, table: str) -> None:
    """Exactly-once ingest, resumable: the stream's state lies beside the store, and what a crash between data and
    state delivers again is known by its content."""
    run_to_table(stream, "append", lambda df, batch: store.commit_once(table, None, df), f"{store.root}/{table}/stream-state")


def route_late(events: DataFrame, as_of: str) -> DataFrame:
    """Each event admitted, future (after as_of) or unknown (no time)."""
    kind = F.when(F.col("ts").isNull(), "unknown").when(F.col("ts") > F.lit(as_of).cast("timestamp"), "future").otherwise("admitted")
    return events.withColumn("intake", kind)
