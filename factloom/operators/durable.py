"""Lineage cuts that survive lost executors: a table in the folder that the cluster shares."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir; a folder of our own only where it is unset and all tasks run in this process."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not root:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        root = "file://" + os.path.join(tempfile.gettempdir(), "factloom-shared")
        spark.conf.set("spark.checkpoint.dir", root)
    return root.rstrip("/")


def delete_at_exit(spark: SparkSession, path: str) -> None:
    """What lies at path goes when the driver ends."""
    path = spark._jvm.org.apache.hadoop.fs.Path(path)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(path)


def cut(df: DataFrame, name: str) -> DataFrame:
    """df as a table in the shared folder, which goes when the driver ends."""
    path = f"{shared_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    delete_at_exit(df.sparkSession, path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
