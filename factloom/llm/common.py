"""Helpers shared by the training-data operators: durable cuts of lineage and Arrow row mapping."""

from __future__ import annotations

import os
import sys
import tempfile
import types
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

#: Rows that a Python mapper turns into Python objects at a time.
SLICE = 256


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, from spark.checkpoint.dir.

    Only where that setting is absent and all tasks run in this process (a local master, as in tests) a folder of
    our own is set; a cluster without the setting is refused, for its machines have no folder in common.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not root:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        root = "file://" + os.path.join(tempfile.gettempdir(), "factloom-shared")
        spark.conf.set("spark.checkpoint.dir", root)
    return root.rstrip("/")


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def delete_at_exit(spark: SparkSession, path: str) -> None:
    """What lies at path goes when the driver ends, if not before."""
    path = spark._jvm.org.apache.hadoop.fs.Path(path)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(path)


def cut(df: DataFrame, name: str) -> DataFrame:
    """Write df as Parquet in the shared folder and read it back: lineage ends here, executors may go."""
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    delete_at_exit(df.sparkSession, path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._cut_path = path
    return out


def drop_cut(df: DataFrame) -> None:
    """Remove the files of a cut that nothing reads any more."""
    spark = df.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path(df._cut_path)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


#: Bounds of an Arrow batch between Spark and Python; long texts count by their bytes.
BATCH = {"spark.sql.execution.arrow.maxRecordsPerBatch": "1000", "spark.sql.execution.arrow.maxBytesPerBatch": str(8 << 20)}


def bounded_batches(spark: SparkSession) -> None:
    """Batches to Python are bounded by rows and bytes, unless the session says otherwise."""
    given = spark.conf.getAll
    for key, value in BATCH.items():
        if key not in given:
            spark.conf.set(key, value)


def map_rows(df: DataFrame, fn: Callable[[Iterator[list[dict]]], Iterator[list[tuple]]], schema: T.StructType) -> DataFrame:
    """Run fn over slices of row dicts of each partition; fn yields lists of tuples in schema's order."""
    bounded_batches(df.sparkSession)
    arrow_schema = to_arrow_schema(schema)

    def run(batches):
        def slices():
            for batch in batches:
                for at in range(0, batch.num_rows, SLICE):
                    yield batch.slice(at, SLICE).to_pylist()

        for rows in fn(slices()):
            if rows:
                columns = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(columns, arrow_schema, strict=True)], schema=arrow_schema)

    return df.mapInArrow(run, schema)


def squeezed(text: str) -> bytes:
    """The text as compressed bytes, for tables and shuffles that carry whole texts; never of a null."""
    data = text.encode("utf-8", "surrogatepass")
    return len(data).to_bytes(8, "little") + pa.compress(data, "zstd", asbytes=True)


def unsqueezed(z: bytes) -> str:
    size = int.from_bytes(z[:8], "little")
    return pa.decompress(z[8:], size, "zstd", asbytes=True).decode("utf-8", "surrogatepass") if size else ""


def kept_by_process(key: tuple, make: Callable):
    """make(), once in each Python process; workers that Spark uses again keep it from task to task.

    The package travels to workers by value, so a module's own globals start anew with each task, and a
    cache object of the package could not be pickled. What is kept lies in a module of this process instead.
    """
    held = sys.modules.setdefault("_factloom_kept", types.ModuleType("_factloom_kept")).__dict__
    if key not in held:
        held[key] = make()
    return held[key]


def pick(df: DataFrame, **columns: str) -> DataFrame:
    """Exactly the named input columns, under the operator's own names; other columns can't clash."""
    return df.select(*[F.col(f"`{c}`").alias(name) for name, c in columns.items()])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
