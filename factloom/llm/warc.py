"""WARC archives: write a capture's records, read archives back, assemble transactions.

Writing is Spark's text writer with the record separator of the format as line separator, so an
archive is a plain WARC file on any storage Spark can write, committed by task like other output. Each capture
has a request, a response (or a revisit of the first equal payload) and a metadata record, tied
together by WARC-Concurrent-To.

Reading streams archives: Spark's text reader hands on what lies between record separators, in order (a gzip file is
one split), and the records are put together again from those pieces by Content-Length, so a task holds one record
and what the batch it came in holds, whatever the archive's size. Payload digests are checked and each record
yields a row. Assembly groups the records of a capture by the identifier that they are concurrent to, and emits one nested row.

Equal payloads: digests are grouped with partial aggregation, so a payload that a third of all pages
share is one row a task. A revisit names the page and the record that it refers to, and that record's address. Defined
cases: null html: empty payload; very long html: whole; payloads under min_revisit bytes: always
responses; repeated rows: each is a capture; null page_id or url: written as empty, read as null; an empty
table: no archive and no row; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from factloom.llm.common import delete_at_exit, fresh_path, map_rows, pick

END = "\r\n\r\n"


@dataclass(frozen=True)
class WarcParams:
    """min_revisit: bytes from which equal payloads are revisits; records_per_file: records of an archive."""

    min_revisit: int = 100
    records_per_file: int = 6000
    date: str = "2024-01-01T00:00:00Z"


def _header(fields: list[tuple[str, Column]]) -> Column:
    parts = [F.lit("WARC/1.1\r\n")]
    for name, value in fields:
        parts.append(F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit("\r\n")), F.lit("")))
    return F.concat(*parts, F.lit("\r\n"))


def _uuid(kind: str, capture: str = "capture") -> Column:
    h = F.md5(F.concat(F.lit(kind), F.col(capture).cast("string"), F.col("digest")))
    return F.concat(F.lit("<urn:uuid:"), F.regexp_replace(h, "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5"), F.lit(">"))


def records(pages: DataFrame, p: WarcParams) -> DataFrame:
    """One string a record, without the separator. pages: page_id, url, html."""
    octets = lambda c: F.octet_length(c).cast("string")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.regexp_replace("url", r"[\r\n]", " ").alias("url"), F.coalesce("html", F.lit("")).alias("html"))
    rows = rows.withColumn("digest", F.sha2("html", 256)).withColumn("bytes", F.octet_length("html")).withColumn("capture", F.monotonically_increasing_id())
    one = F.struct("page_id", "capture", "url")
    known = rows.where((F.col("bytes") >= p.min_revisit) & F.col("page_id").isNotNull())
    firsts = known.groupBy("digest").agg(F.min(one).alias("one"), F.count("*").alias("copies")).where("copies > 1")
    firsts = firsts.select("digest", F.col("one.page_id").alias("first"), F.col("one.capture").alias("first_capture"), F.col("one.url").alias("first_url"))
    rows = rows.join(firsts, "digest", "left")
    revisit = F.col("first").isNotNull() & (F.col("page_id") != F.col("first"))
    page = F.coalesce(F.col("page_id").cast("string"), F.lit(""))
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("bytes").cast("string"), F.lit(END))
    block = F.when(revisit, http).otherwise(F.concat(http, F.col("html")))
    ask = F.concat(F.lit("GET / HTTP/1.1\r\nHost: "), F.coalesce(F.regexp_extract("url", "^[a-z]+://([^/?#]+)", 1), F.lit("")), F.lit(END))
    notes = F.concat(F.lit("page: "), page, F.lit("\r\nfetchTimeMs: 0\r\n"))
    common = [("WARC-Date", F.lit(p.date)), ("WARC-Target-URI", F.col("url"))]
    main = F.concat(
        _header([("WARC-Type", F.when(revisit, "revisit").otherwise("response")), ("WARC-Record-ID", _uuid("main")), *common, ("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest"))), ("WARC-Profile", F.when(revisit, "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")), ("WARC-Page", page), ("WARC-Refers-To", F.when(revisit, _uuid("main", "first_capture"))), ("WARC-Refers-To-Target-URI", F.when(revisit, F.col("first_url"))), ("WARC-Refers-To-Page", F.when(revisit, F.col("first").cast("string"))), ("Content-Type", F.lit("application/http;msgtype=response")), ("Content-Length", octets(block))]),
        block,
    )
    request = F.concat(_header([("WARC-Type", F.lit("request")), ("WARC-Record-ID", _uuid("request")), ("WARC-Concurrent-To", _uuid("main")), *common, ("Content-Type", F.lit("application/http;msgtype=request")), ("Content-Length", octets(ask))]), ask)
    metadata = F.concat(_header([("WARC-Type", F.lit("metadata")), ("WARC-Record-ID", _uuid("metadata")), ("WARC-Concurrent-To", _uuid("main")), *common, ("Content-Type", F.lit("application/warc-fields")), ("Content-Length", octets(notes))]), notes)
    return rows.select(F.explode(F.array(request, main, metadata)).alias("value"))


def write_archives(pages: DataFrame, path: str, params: WarcParams = WarcParams(), id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> str:
    """Write gzip WARC archives into the folder path; returns it."""
    out = records(pick(pages, page_id=id_col, url=url_col, html=html_col), params)
    out.write.option("lineSep", END).option("compression", "gzip").option("maxRecordsPerFile", params.records_per_file).text(path)
    return path


RECORD = T.StructType([T.StructField("archive", T.StringType()), T.StructField("at", T.LongType()), T.StructField("type", T.StringType()), T.StructField("record_id", T.StringType()), T.StructField("concurrent_to", T.StringType()), T.StructField("url", T.StringType()), T.StructField("page_id", T.LongType()), T.StructField("refers_to", T.LongType()), T.StructField("refers_to_record", T.StringType()), T.StructField("payload_bytes", T.LongType()), T.StructField("payload_digest", T.StringType()), T.StructField("payload", T.BinaryType())])


SEPARATOR = END.encode()


class Records:
    """The records of archives, from the pieces between separators as they come.

    A block may hold separators itself, and its end may run into one, so records are cut from the bytes that
    the pieces and the separators between them make up; whether one follows the last piece isn't known.
    """

    def __init__(self):
        self.name, self.held, self.size, self.at, self.need, self.fields = None, [], 0, 0, None, {}

    def feed(self, name: str, piece: bytes) -> Iterator[tuple]:
        """Rows of RECORD that the next piece of an archive completes."""
        if name != self.name:
            yield from self.end()
            self.name, self.held, self.size, self.at = name, [piece], len(piece), 0
        else:
            self.held += [SEPARATOR, piece]
            self.size += 4 + len(piece)
        while self.need is None or self.size >= self.need + 4:
            data = b"".join(self.held)
            if self.need is None:
                used = data.find(SEPARATOR) + 4
                if not data.startswith(b"WARC/1."[: len(data)]):
                    raise ValueError(f"no record at {self.at} of {name}")
                if used < 4:
                    break
                self.fields, self.start = header_fields(data[: used - 4]), self.at
                self.need = int(self.fields[b"content-length"])
            else:
                used = self.need + 4
                if data[self.need : used] != SEPARATOR:
                    raise ValueError(f"a length that doesn't fit the record at {self.start} of {name}")
                yield row_of(name, self.start, self.fields, data[: self.need])
                self.need = None
            self.at += used
            self.held, self.size = [data[used:]], len(data) - used

    def end(self) -> Iterator[tuple]:
        """The last record of an archive, whose separator ends the file."""
        data = b"".join(self.held)
        if self.need is not None and len(data) >= self.need and SEPARATOR.startswith(data[self.need :]):
            yield row_of(self.name, self.start, self.fields, data[: self.need])
        elif data or self.need is not None:
            raise ValueError(f"a short record at {self.at} of {self.name}")
        self.held, self.need = [], None


def header_fields(head: bytes) -> dict[bytes, str]:
    out = {}
    for line in head.split(b"\r\n")[1:]:
        key, _, value = line.partition(b":")
        out[key.strip().lower()] = value.strip().decode("utf-8", "replace")
    return out


def row_of(name: str, at: int, fields: dict[bytes, str], block: bytes) -> tuple:
    """A row of RECORD; a payload that its digest doesn't match raises ValueError."""
    kind, payload, length, digest = fields.get(b"warc-type"), block, len(block), None
    if kind in ("response", "revisit"):
        head, _, payload = block.partition(b"\r\n\r\n")
        told = re.search(rb"(?im)^content-length:\s*(\d+)", head)
        length = int(told[1]) if told else len(payload)
        digest = fields.get(b"warc-payload-digest", "").removeprefix("sha256:")
        if kind == "response" and (hashlib.sha256(payload).hexdigest() != digest or len(payload) != length):
            raise ValueError(f"a payload that its digest doesn't match at {at} of {name}")
    number = lambda key: int(v) if (v := fields.get(key)) else None
    return (name, at, kind, fields.get(b"warc-record-id"), fields.get(b"warc-concurrent-to"), fields.get(b"warc-target-uri"), number(b"warc-page"), number(b"warc-refers-to-page"), fields.get(b"warc-refers-to"), length, digest, None if kind == "revisit" else payload)


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """A row of RECORD for each record of the gzip archives in the folder."""
    pieces = spark.read.option("lineSep", END).option("pathGlobFilter", "*.gz").text(path).select(F.col("_metadata.file_name").alias("archive"), F.col("value").cast("binary").alias("piece"))

    def run(slices):
        records = Records()
        for rows in slices:
            out = []
            for r in rows:
                out += records.feed(r["archive"], r["piece"])
            yield out
        yield [*records.end()]

    return map_rows(pieces, run, RECORD)


def assemble(found: DataFrame) -> DataFrame:
    """One row a capture: capture_id and the structs request, response and metadata (null if absent).

    A record that is concurrent to another belongs to that one's capture; others start their own. found
    may lack the payload column.
    """
    fields = [c for c in found.columns if c not in ("concurrent_to",)]
    part = lambda name, *kinds: F.any_value(F.when(F.col("type").isin(*kinds), F.struct(*fields)), ignoreNulls=F.lit(True)).alias(name)
    return found.groupBy(F.coalesce("concurrent_to", "record_id").alias("capture_id")).agg(part("request", "request"), part("response", "response", "revisit"), part("metadata", "metadata"))


def digest(captures: DataFrame) -> DataFrame:
    """The contract's columns from assembled captures."""
    r = F.col("response")
    return captures.where(r.isNotNull()).select(r["page_id"].alias("page_id"), r["payload_bytes"].alias("payload_bytes"), r["payload_digest"].alias("payload_digest"), r["type"].alias("record_type"), r["refers_to"].alias("refers_to"), r["url"].alias("url"), F.col("request").isNotNull().alias("has_request"), F.col("metadata").isNotNull().alias("has_metadata"))


def round_trip(pages: DataFrame, params: WarcParams = WarcParams()) -> DataFrame:
    """Write archives to the shared folder, read them back and return the assembled captures' digest."""
    spark = pages.sparkSession
    path = write_archives(pages, fresh_path(spark, "warc"), params)
    delete_at_exit(spark, path)
    return digest(assemble(read_archives(spark, path).drop("payload")))
