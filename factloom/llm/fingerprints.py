"""I-Match document fingerprints with randomised lexicons.

The lexicon holds the terms whose inverse document frequency over the whole corpus lies in a band:
neither in nearly every document nor in a handful. A document's kept terms are sorted, distinct
and hashed once for each of several random subsets of the lexicon (of falling size, so that long and
short texts both have subsets in which few terms count). Two fingerprints' likeness is the share of
equal subset hashes among the subsets where either has a term, over the subset sizes that fit the
longer of the two.

Size of the lexicon: a term of the band is in at least N / e^idf_high documents, so there are at most
(mean distinct terms) * e^idf_high of them whatever N is, at about 20 bytes a term with their subsets. All
of them are used: the band never depends on their number. Beyond spark.driver.maxResultSize the query
fails with Spark's error.

Neighbours in order of ids: a narrow pass over ids alone finds where each of as many ranges as there are shuffle
partitions begins (one row a range reaches the driver). Then each text, compressed, goes once to the task
of its range; the first row of a range goes also to the end of the range before, so every task
sees the followers of all its rows and no result is written twice. A task streams its rows and holds two of them.

Defined cases: null or empty text: no terms; no term in the band: the empty fingerprint (all zeros), which equals
itself only: its likeness is 1 to another empty one and 0 to any other; equal ids: in order of their texts'
hashes; null ids come first; repeated rows: each has a neighbour; one row: it is its own neighbour; empty
table: no rows; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from factloom.llm.common import bounded_batches, cut, drop_cut, map_rows, pick
from factloom.llm.neardup import GOLD, WordHashes, mix64

#: Term hashes that a task gathers before it counts them.
HELD = 2_000_000


@dataclass(frozen=True)
class FingerprintParams:
    """idf band in nats; scales: shares of the lexicon in a subset; subsets of each scale."""

    idf_low: float = 1.5
    idf_high: float = 7.5
    scales: tuple[float, ...] = (1 / 8, 1 / 32, 1 / 128, 1 / 512)
    subsets: int = 32
    seed: int = 3


def terms(text: str | None, cache: WordHashes) -> np.ndarray:
    """Sorted distinct hashes of the lower-case words."""
    words = (text or "").lower().encode("utf-8", "surrogatepass").split()
    return np.unique(np.fromiter(map(cache.__getitem__, words), np.uint64, len(words)))


def document_frequency(docs: DataFrame) -> DataFrame:
    """term, df over all documents; combined in each task before the shuffle."""
    schema = T.StructType([T.StructField("term", T.LongType()), T.StructField("n", T.LongType())])

    def run(batches):
        cache = WordHashes()
        found, n, held, size = np.empty(0, np.uint64), np.empty(0, np.int64), [], 0

        def merged():
            each, where = np.unique(np.concatenate([found, *held]), return_inverse=True)
            return each, np.bincount(where, np.r_[n, np.ones(size)], len(each)).astype(np.int64)

        for batch in batches:
            for text in batch.column(0):
                t = terms(text.as_py(), cache)
                held.append(t)
                size += len(t)
                if size >= HELD:
                    found, n = merged()
                    held, size = [], 0
                    if len(found) >= HELD:
                        yield pa.record_batch([found.view(np.int64), n], ["term", "n"])
                        found, n = found[:0], n[:0]
        found, n = merged()
        if len(found):
            yield pa.record_batch([found.view(np.int64), n], ["term", "n"])

    return docs.select("text").mapInArrow(run, schema).groupBy("term").agg(F.sum("n").alias("df"))


def lexicon(docs: DataFrame, p: FingerprintParams) -> np.ndarray:
    """Sorted term hashes of the band."""
    n = docs.count()
    idf = F.log(F.lit(float(max(n, 1))) / F.col("df"))
    band = cut(document_frequency(docs).withColumn("idf", idf).where((F.col("idf") >= p.idf_low) & (F.col("idf") <= p.idf_high)), "imatch-band")
    out = np.sort(np.array(band.select("term").toPandas()["term"], np.int64).view(np.uint64))
    drop_cut(band)
    return out


class Fingerprinter:
    """The lexicon and, for each of its terms, the subsets that hold it (a random draw by the term's hash)."""

    def __init__(self, lex: np.ndarray, p: FingerprintParams):
        self.lex, self.p = lex, p
        self.k = p.subsets * len(p.scales)
        seeds = mix64((np.arange(1, self.k + 1, dtype=np.uint64) + np.uint64(p.seed * 1000)) * GOLD)
        limits = np.repeat([np.uint64(int(s * 2.0**64) - 1) for s in p.scales], p.subsets)
        subsets, sizes = [np.empty(0, np.uint8)], [np.zeros(1, np.int64)]
        for at in range(0, len(lex), 65_536):
            member = mix64(lex[at : at + 65_536, None] ^ seeds[None, :]) <= limits[None, :]
            subsets.append(np.nonzero(member)[1].astype(np.uint8))
            sizes.append(member.sum(1))
        self.subset, self.start = np.concatenate(subsets), np.cumsum(np.concatenate(sizes))

    def of(self, found: np.ndarray) -> bytes:
        """4 bytes for each subset, the hash of its kept terms in order; zeros where the document has none of it."""
        out = np.zeros(self.k, "<u4")
        if not len(self.lex) or not len(found):
            return out.tobytes()
        at = np.minimum(np.searchsorted(self.lex, found), len(self.lex) - 1)
        at = at[self.lex[at] == found]
        first, sizes = self.start[at], self.start[at + 1] - self.start[at]
        total = int(sizes.sum())
        if not total:
            return out.tobytes()
        term = np.repeat(self.lex[at], sizes)
        subset = self.subset[np.arange(total) + np.repeat(first - (np.cumsum(sizes) - sizes), sizes)]
        order = np.argsort(subset, kind="stable")
        subset, term = subset[order], term[order]
        each = np.flatnonzero(np.r_[True, subset[1:] != subset[:-1]])
        place = np.arange(total) - np.repeat(each, np.diff(np.r_[each, total]))
        mixed = mix64(term + place.astype(np.uint64) * GOLD)
        hashes = (mix64(np.add.reduceat(mixed, each)) >> np.uint64(32)).astype(np.uint32)
        out[subset[each]] = np.maximum(hashes, 1)
        return out.tobytes()

    def likeness(self, a: bytes, b: bytes) -> float:
        """Over the scale whose subsets hold about one term of the two documents together."""
        x = np.frombuffer(a, "<u4").reshape(len(self.p.scales), -1)
        y = np.frombuffer(b, "<u4").reshape(len(self.p.scales), -1)
        used = (x != 0) | (y != 0)
        share = used.sum(1)
        if not share.any():
            return 1.0
        # the finest scale that at least a quarter of the subsets use, else the coarsest
        fine = np.flatnonzero(4 * share >= used.shape[1])
        i = int(fine[-1]) if len(fine) else int(share.argmax())
        return float(((x[i] == y[i]) & used[i]).sum() / share[i])


OUT = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("n_chars", T.LongType()), T.StructField("edited_sha256", T.StringType()), T.StructField("fingerprint", T.StringType()), T.StructField("edited_fingerprint", T.StringType()), T.StructField("near_edited", T.DoubleType()), T.StructField("near_next", T.DoubleType())])


def edited(text: str, following: str) -> str:
    k = len(text) // 4
    return text[: len(text) - k] + following[:k]


def ranges(rows: DataFrame, many: int) -> np.ndarray:
    """The first (order, th) of each of at most `many` ranges of about as many rows; sorted, distinct."""
    ordered = rows.select("order", "th").repartitionByRange(many, "order", "th")
    firsts = ordered.groupBy(F.spark_partition_id().alias("part")).agg(F.min(F.struct("order", "th")).alias("first"))
    return np.array(sorted({(r["first"]["order"], r["first"]["th"]) for r in firsts.collect()}), np.dtype([("order", np.int64), ("th", np.int64)]))


def in_ranges(rows: DataFrame, bounds: np.ndarray) -> DataFrame:
    """Each row at its range, and each range's first row also at the end (tail) of the range before."""
    schema = T.StructType([T.StructField("range", T.IntegerType()), T.StructField("tail", T.BooleanType()), T.StructField("order", T.LongType()), T.StructField("th", T.LongType()), T.StructField("id", T.LongType()), T.StructField("z", T.BinaryType()), T.StructField("size", T.IntegerType())])

    def run(batches):
        codec = pa.Codec("zstd", 1)
        for batch in batches:
            keys = np.empty(batch.num_rows, bounds.dtype)
            keys["order"], keys["th"] = batch.column("order").to_numpy(), batch.column("th").to_numpy()
            at = np.searchsorted(bounds, keys, side="right") - 1
            again = np.flatnonzero(bounds[at] == keys)
            texts = [t.as_buffer() if t.is_valid else pa.py_buffer(b"") for t in batch.column("text")]
            z = pa.array([codec.compress(t, asbytes=True) for t in texts], pa.binary())
            size = pa.array([t.size for t in texts], pa.int32())
            each = np.r_[np.arange(batch.num_rows), again]
            take = pa.array(each)
            where = np.r_[at, (at[again] - 1) % len(bounds)].astype(np.int32)
            tail = np.arange(len(each)) >= batch.num_rows
            columns = [batch.column("order").take(take), batch.column("th").take(take), batch.column("id").take(take), z.take(take), size.take(take)]
            yield pa.record_batch([pa.array(where), pa.array(tail), *columns], schema.fieldNames())

    return rows.select("order", "th", "id", "text").mapInArrow(run, schema)


def fingerprint_neighbours(docs: DataFrame, params: FingerprintParams = FingerprintParams(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per input row: OUT's columns, for the text and its edit with the next document's beginning."""
    p = params
    rows = pick(docs, id=id_col, text=text_col).withColumn("id", F.col("id").cast("long"))
    bounded_batches(docs.sparkSession)
    rows = rows.withColumn("order", F.coalesce("id", F.lit(-(2**63)))).withColumn("th", F.xxhash64(F.coalesce("text", F.lit(""))))
    many = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    bounds = ranges(rows, many)
    if not len(bounds):
        return docs.sparkSession.createDataFrame([], OUT)
    printer = Fingerprinter(lexicon(rows, p), p)

    def run(slices):
        cache, codec, before, ended = WordHashes(), pa.Codec("zstd"), None, False
        for rows_ in slices:
            out = []
            for r in rows_:
                if ended:
                    break  # further tails repeat the first
                text = codec.decompress(r["z"], r["size"], asbytes=True).decode("utf-8", "surrogatepass") if r["size"] else ""
                mine = printer.of(terms(text, cache))
                if before is not None:
                    number, old, print_ = before
                    new = edited(old, text)
                    other = printer.of(terms(new, cache))
                    out.append((number, len(old), hashlib.sha256(new.encode("utf-8", "surrogatepass")).hexdigest(), print_.hex(), other.hex(), printer.likeness(print_, other), printer.likeness(print_, mine)))
                before, ended = (r["id"], text, mine), r["tail"]
            yield out

    dealt = in_ranges(rows, bounds).repartitionById(max(many, len(bounds)), F.col("range")).sortWithinPartitions("tail", "order", "th")
    return map_rows(dealt, run, OUT)
