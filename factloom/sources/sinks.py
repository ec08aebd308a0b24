"""Sinks: generations with an atomic pointer, exactly-once commits, sheets, JSON lines, bundles.

Small control files (pointers, receipts, manifests) go through Hadoop's file system, so they work wherever Spark
can write. Such a file is written aside and appears under its own, new name by one rename; none is ever replaced or
deleted before its successor is there. A table's visible generation is the greatest that has a pointer file.
"""

from __future__ import annotations

import hashlib
import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from factloom.functions.scalars import csv_protect
from factloom.operators.ranks import numbered


class Store:
    """Derived tables in root/table/generation=N; root/table/CURRENT-N makes generation N and later ones visible."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.root).getFileSystem(spark._jsc.hadoopConfiguration())

    def _read(self, name: str) -> str | None:
        path = self._path(f"{self.root}/{name}")
        if not self._fs.exists(path):
            return None
        stream = self._fs.open(path)
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def _create(self, name: str, text: str) -> bool:
        """A new control file, whole or not at all; False if the name is taken."""
        aside = self._path(f"{self.root}/{name}.{uuid.uuid4().hex}.tmp")
        out = self._fs.create(aside)
        out.write(bytearray(text.encode()))
        out.close()
        target = self._path(f"{self.root}/{name}")
        if not self._fs.exists(target) and self._fs.rename(aside, target):
            return True
        self._fs.delete(aside, False)
        return False

    def _greatest(self, folder: str, prefix: str) -> int:
        """The greatest number of the files prefix-N in the folder, 0 without any."""
        path = self._path(f"{self.root}/{folder}")
        names = [s.getPath().getName() for s in self._fs.listStatus(path)] if self._fs.exists(path) else []
        return max((int(n.removeprefix(prefix)) for n in names if n.startswith(prefix) and n.removeprefix(prefix).isdigit()), default=0)

    def generation(self, table: str) -> int:
        return self._greatest(table, "CURRENT-")

    def publish(self, table: str, df: DataFrame) -> int:
        """Write the next generation, then its pointer; readers see the old one or the new one, whenever this stops."""
        n = self.generation(table) + 1
        df.write.mode("overwrite").parquet(f"{self.root}/{table}/generation={n}")
        if not self._create(f"{table}/CURRENT-{n}", str(n)):
            raise ValueError(f"generation {n} of {table} was published by another writer")
        return n

    def read(self, table: str, generation: int | None = None) -> DataFrame:
        return self.spark.read.parquet(f"{self.root}/{table}/generation={generation or self.generation(table)}")

    def freeze(self, table: str, df: DataFrame, order: list[str], rows: int) -> int:
        """The table in chunks of `rows` rows in order, each with its count and digest in a manifest; returns the chunks."""
        path = f"{self.root}/{table}/frozen"
        chunk = F.floor((F.col("rank") - 1) / rows).cast("long")
        numbered(df, [], order).withColumn("chunk", chunk).drop("rank").repartition("chunk").write.partitionBy("chunk").parquet(path)
        self._digests(self.spark.read.parquet(path), df.columns).write.parquet(f"{path}-manifest")
        return self.spark.read.parquet(f"{path}-manifest").count()

    def _digests(self, df: DataFrame, columns: list[str]) -> DataFrame:
        h = F.sum(F.xxhash64(F.struct(*sorted(columns))).cast("decimal(38,0)"))
        return df.groupBy(F.col("chunk").cast("long").alias("chunk")).agg(F.count("*").alias("n"), h.alias("digest"))

    def visit(self, table: str, first: int, last: int) -> DataFrame:
        """The rows of the chunks first to last, after each has been held against the manifest."""
        path = f"{self.root}/{table}/frozen"
        inside = F.col("chunk").between(first, last)
        rows = self.spark.read.parquet(path).where(inside)
        told = self.spark.read.parquet(f"{path}-manifest").where(inside)
        now = self._digests(rows, [c for c in rows.columns if c != "chunk"])
        if not told.exceptAll(now).isEmpty() or not now.exceptAll(told).isEmpty():
            raise ValueError(f"a chunk of {table} isn't what was frozen")
        return rows.withColumn("chunk", F.col("chunk").cast("long"))

    def inspect(self) -> list[tuple[str, int, int]]:
        """(table, current generation, rows) of every derived table; counts come from Parquet footers."""
        found = sorted(s.getPath().getName() for s in self._fs.listStatus(self._path(self.root)) if s.isDirectory())
        return [(t, n, self.read(t).count()) for t in found if (n := self.generation(t))]

    def reclaim(self, table: str) -> int:
        """Delete generations before the current one, and their pointers after them."""
        now, gone = self.generation(table), 0
        for n in range(1, now):
            gone += self._fs.delete(self._path(f"{self.root}/{table}/generation={n}"), True)
            self._fs.delete(self._path(f"{self.root}/{table}/CURRENT-{n}"), False)
        return gone

    def append(self, table: str, df: DataFrame, order: list[Column]) -> None:
        """Add observations with consecutive sequences after the last one.

        Numbers come from per-partition counts, not from one sorted partition.
        """
        path = f"{self.root}/{table}/log"
        last = self.spark.read.parquet(path).agg(F.max("seq")).first()[0] if self._fs.exists(self._path(path)) else None
        aside = f"{self.root}/{table}/aside-{uuid.uuid4().hex}"
        df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("part", F.spark_partition_id()).withColumn("at", F.monotonically_increasing_id()).write.parquet(aside)
        rows = self.spark.read.parquet(aside)
        counts = rows.groupBy("part").agg(F.count("*").alias("n"))
        base = counts.select("part", F.coalesce(F.sum("n").over(W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("base"))
        seq = F.col("base") + F.row_number().over(W.partitionBy("part").orderBy("at")) + F.lit((last if last is not None else -1))
        rows.join(base, "part").withColumn("seq", seq.cast("long")).drop("part", "at", "base").write.mode("append").parquet(path)
        self._fs.delete(self._path(aside), True)

    def _content(self, path: str) -> str:
        """An order-free digest of the rows of a written table."""
        df = self.spark.read.parquet(path)
        n, h = df.select(F.xxhash64(F.struct(*sorted(df.columns))).cast("decimal(38,0)").alias("h")).agg(F.count("*"), F.coalesce(F.sum("h"), F.lit(0))).first()
        return hashlib.sha256(json.dumps([n, str(h)]).encode()).hexdigest()

    def commit_once(self, table: str, operation: str | None, df: DataFrame) -> str:
        """written, or repeated if the operation was applied; another payload under its name is refused.

        Without a name, the operation is named by its content. Rows are written aside once, then named, then
        get their receipt; a run that stops between any two of these is completed by the next one.
        """
        aside = f"{self.root}/{table}/batches/_aside-{uuid.uuid4().hex}"
        df.write.parquet(aside)
        digest = self._content(aside)
        name = hashlib.sha256((operation or f"content {digest}").encode()).hexdigest()
        known = self._read(f"{table}/receipts/{name}")
        if known:
            self._fs.delete(self._path(aside), True)
            if json.loads(known)["digest"] != digest:
                raise ValueError(f"operation {operation} was applied with another payload")
            return "repeated"
        target = self._path(f"{self.root}/{table}/batches/operation={name[:32]}")
        self._fs.delete(target, True)
        self._fs.rename(self._path(aside), target)
        self._create(f"{table}/receipts/{name}", json.dumps({"operation": operation, "digest": digest}))
        return "written"

    def committed(self, table: str) -> DataFrame:
        """The rows of every operation that has its receipt; operations under way don't show."""
        path = self._path(f"{self.root}/{table}/receipts")
        names = sorted(s.getPath().getName() for s in self._fs.listStatus(path)) if self._fs.exists(path) else []
        base = f"{self.root}/{table}/batches"
        return self.spark.read.option("basePath", base).parquet(*[f"{base}/operation={n[:32]}" for n in names if not n.endswith(".tmp")])

    def bundle(self, name: str, tables: dict[str, DataFrame]) -> dict:
        """Several tables under one manifest of row counts and digests read back from what was written; the manifest seals them.

        Each call builds aside and appears with its manifest, whose number is the greatest.
        """
        n, made = self._greatest(name, "MANIFEST-") + 1, {}
        for table, df in tables.items():
            path = f"{self.root}/{name}/build-{n}/{table}"
            df.write.mode("overwrite").parquet(path)
            made[table] = {"rows": self.spark.read.parquet(path).count(), "digest": self._content(path)}
        if not self._create(f"{name}/MANIFEST-{n}", json.dumps(made, sort_keys=True)):
            raise ValueError(f"bundle {name} was sealed by another writer")
        return made

    def open_bundle(self, name: str) -> dict[str, DataFrame]:
        """The tables of the sealed bundle; a table that its manifest doesn't match is refused."""
        n = self._greatest(name, "MANIFEST-")
        out = {}
        for table, told in json.loads(self._read(f"{name}/MANIFEST-{n}") or "{}").items():
            path = f"{self.root}/{name}/build-{n}/{table}"
            out[table] = self.spark.read.parquet(path)
            if out[table].count() != told["rows"] or self._content(path) != told["digest"]:
                raise ValueError(f"{table} of {name} isn't what was sealed")
        return out


def consolidate(df: DataFrame, path: str) -> None:
    """The merged table as JSON lines."""
    df.write.mode("overwrite").json(path)


def write_sheets(df: DataFrame, path: str, family: str, order: list[str], rows: int = 1_000_000) -> None:
    """CSV sheets of at most `rows` rows: family, page; cells that look like formulas are quoted."""
    page = F.floor((F.col("rank") - 1) / rows) + 1
    safe = [csv_protect(c).alias(c) if t == "string" and c != family else F.col(c) for c, t in df.dtypes]
    numbered(df, [family], order).select(*safe, page.cast("int").alias("page")).write.mode("overwrite").partitionBy(family, "page").option("header", True).csv(path)


def markdown(df: DataFrame, most: int = 200) -> str:
    """A small report frame as a Markdown table; refuses frames over its stated size."""
    rows = df.limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"more than {most} rows")
    lines = ["| " + " | ".join(df.columns) + " |", "|" + "---|" * len(df.columns)]
    return "\n".join(lines + ["| " + " | ".join("" if v is None else str(v).replace("|", "\\|") for v in r) + " |" for r in rows])
