"""Media columns: a Spark data source over directories of image archives.

Payloads are kept losslessly as 8-bit grey PNG images, a row of pixels for each `width` bytes, in archives
that simply append members; beside each archive lies an index of its members (offset, length, checksum).
The data source "factloom_media" plans byte ranges over the archives of a directory from file sizes alone; a
range holds the members that start in it, found in the archive's index. Members stream through Arrow in
batches of bounded size. A member that fails to read or to match its checksum is read again by
its offset, alone; one that still fails is returned with its error, not dropped.

Archives are written by the same source's writer: each task rolls archives at a size bound under names of
its own, and only those of committed tasks are listed in the directory's manifest, so lost executors
leave nothing that is read. Files go through pyarrow's file systems, so a directory may be in any store.

Defined cases: null or empty payload: one row of fill bytes; repeated rows: each is a member; an empty
table: a manifest without archives, read as no rows; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
import struct
import time
import uuid
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage

from factloom.llm.common import delete_at_exit, fresh_path, map_rows, pick

# The PNG signature, and the fill byte and row width of the contract.
SIGNATURE = b"\x89PNG\r\n\x1a\n"
FILL = 255
WIDTH = 576
TAIL = 32


def chunk(kind: bytes, data: bytes) -> bytes:
    return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))


def encode_png(samples: bytes, width: int, level: int = 4) -> bytes:
    """8-bit grey, no filter; len(samples) is a multiple of width."""
    height = len(samples) // width
    rows = np.zeros((height, width + 1), np.uint8)
    rows[:, 1:] = np.frombuffer(samples, np.uint8).reshape(height, width)
    return SIGNATURE + chunk(b"IHDR", struct.pack(">IIBBBBB", width, height, 8, 0, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(rows.tobytes(), level)) + chunk(b"IEND", b"")


def decode_png(data: bytes) -> tuple[int, bytes]:
    """(width, samples) of an image that encode_png wrote; ValueError for any damage."""
    if not data.startswith(SIGNATURE):
        raise ValueError("no PNG signature")
    at, parts, width, height = len(SIGNATURE), [], 0, 0
    while at < len(data):
        (n,), kind = struct.unpack_from(">I", data, at), data[at + 4 : at + 8]
        body = data[at + 8 : at + 8 + n]
        if struct.unpack_from(">I", data, at + 8 + n)[0] != zlib.crc32(kind + body):
            raise ValueError("a chunk's checksum differs")
        if kind == b"IHDR":
            width, height, *form = struct.unpack(">IIBBBBB", body)
            if form != [8, 0, 0, 0, 0]:
                raise ValueError("not 8-bit grey")
        elif kind == b"IDAT":
            parts.append(body)
        at += 12 + n
    rows = np.frombuffer(zlib.decompress(b"".join(parts)), np.uint8).reshape(height, width + 1)
    if rows[:, 0].any():
        raise ValueError("a filter that isn't used here")
    return width, rows[:, 1:].tobytes()


def padded(payload: bytes, width: int = WIDTH) -> bytes:
    """The payload with fill bytes up to a positive multiple of the width."""
    return payload + bytes([FILL]) * (max(width, -(-len(payload) // width) * width) - len(payload))


def feature(samples: bytes, width: int = WIDTH) -> str:
    """Mean, spread and edge strength of the pixels and an 8 x 8 average hash, as text."""
    x = np.frombuffer(samples, np.uint8).reshape(-1, width).astype(np.float64)
    row = np.arange(len(x)) * 8 // len(x)
    cells = np.zeros((8, 8))
    np.add.at(cells, row, x.reshape(len(x), 8, -1).sum(2))
    n = np.bincount(row, minlength=8)[:, None] * (width // 8)
    means = np.divide(cells, n, out=np.zeros_like(cells), where=n > 0)
    bits = np.packbits((means > x.mean()).ravel()).tobytes().hex()
    return f"{x.mean():.3f};{x.std():.3f};{np.abs(np.diff(x, axis=1)).mean():.3f};{bits}"


@dataclass
class ByteRange(InputPartition):
    archive: str
    start: int
    stop: int


@dataclass
class Written(WriterCommitMessage):
    archives: list


#: Schemes of Hadoop's stores by the name that pyarrow has for them.
SCHEMES = {"s3a": "s3", "s3n": "s3", "abfss": "abfs", "wasbs": "abfs", "webhdfs": "hdfs"}


def open_store(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a path or URI, and the path in it."""
    if "://" not in path and not path.startswith("file:"):
        return pafs.LocalFileSystem(), path
    scheme, colon, rest = path.partition(":")
    return pafs.FileSystem.from_uri(SCHEMES.get(scheme, scheme) + colon + rest)


INDEX = pa.schema([("id", pa.int64()), ("n_bytes", pa.int64()), ("offset", pa.int64()), ("length", pa.int64()), ("crc", pa.int64())])
MEMBERS = pa.schema([("id", pa.int64()), ("n_bytes", pa.int64()), ("archive", pa.string()), ("offset", pa.int64()), ("media", pa.binary()), ("tries", pa.int32()), ("error", pa.string())])


class MediaReader(DataSourceReader):
    """Options: path, range_mb (bytes planned for a task), batch_mb (payload of an Arrow batch), retries."""

    def __init__(self, options):
        self.path = options["path"].rstrip("/")
        self.range = int(float(options.get("range_mb", "32")) * 1e6)
        self.batch = int(float(options.get("batch_mb", "8")) * 1e6)
        self.retries = int(options.get("retries", "3"))

    def partitions(self):
        fs, root = open_store(self.path)
        with fs.open_input_stream(f"{root}/MANIFEST.json") as f:
            archives = json.loads(f.read())
        out = [ByteRange(name, at, min(at + self.range, size)) for name, size in archives for at in range(0, size, self.range)]
        return out or [ByteRange("", 0, 0)]

    def member(self, fs, name: str, offset: int, length: int, crc: int) -> tuple[bytes | None, int, str | None]:
        """(media, tries, error): each try opens the archive anew and reads only this member."""
        error = None
        for k in range(1, self.retries + 1):
            try:
                with fs.open_input_file(name) as f:
                    data = f.read_at(length, offset)
                if len(data) == length and zlib.crc32(data) == crc:
                    return data, k, None
                error = "its bytes don't match the index"
            except OSError as e:
                error = str(e)
            time.sleep(0.05 * 2**k)
        return None, self.retries, error

    def read(self, part):
        if not part.archive:
            return
        fs, root = open_store(self.path)
        name = f"{root}/{part.archive}"
        with fs.open_input_file(name + ".idx") as f, pa.ipc.open_file(f) as reader:
            index = reader.read_all()
        offsets = index["offset"].to_numpy()
        a, b = np.searchsorted(offsets, [part.start, part.stop])
        rows, held = [], 0
        with fs.open_input_file(name) as f:
            for r in index.slice(a, b - a).to_pylist():
                try:
                    data, tries, error = f.read_at(r["length"], r["offset"]), 0, None
                    if len(data) != r["length"] or zlib.crc32(data) != r["crc"]:
                        data, tries, error = self.member(fs, name, r["offset"], r["length"], r["crc"])
                except OSError:
                    data, tries, error = self.member(fs, name, r["offset"], r["length"], r["crc"])
                rows.append((r["id"], r["n_bytes"], part.archive, r["offset"], data, tries, error))
                held += r["length"]
                if held >= self.batch or len(rows) >= 4096:
                    yield batch_of(rows)
                    rows, held = [], 0
        if rows:
            yield batch_of(rows)


def batch_of(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), MEMBERS, strict=True)], schema=MEMBERS)


class MediaWriter(DataSourceArrowWriter):
    """Rows (id, n_bytes, media) to archives of at most about archive_mb each."""

    def __init__(self, options):
        self.path = options["path"].rstrip("/")
        self.bound = int(float(options.get("archive_mb", "128")) * 1e6)

    def write(self, iterator):
        fs, root = open_store(self.path)
        fs.create_dir(root, recursive=True)
        done, out, name, index, at = [], None, "", [], 0

        def close():
            out.close()
            with fs.open_output_stream(f"{root}/{name}.idx") as f, pa.ipc.new_file(f, INDEX) as w:
                w.write_table(pa.Table.from_pylist(index, INDEX))
            done.append([name, at])

        for batch in iterator:
            for r in batch.to_pylist():
                if out is None:
                    name, index, at = f"media-{uuid.uuid4().hex}.pngs", [], 0
                    out = fs.open_output_stream(f"{root}/{name}")
                data = r["media"]
                out.write(data)
                index.append({"id": r["id"], "n_bytes": r["n_bytes"], "offset": at, "length": len(data), "crc": zlib.crc32(data)})
                at += len(data)
                if at >= self.bound:
                    close()
                    out = None
        if out is not None:
            close()
        return Written(done)

    def commit(self, messages):
        fs, root = open_store(self.path)
        fs.create_dir(root, recursive=True)
        with fs.open_output_stream(f"{root}/MANIFEST.json") as f:
            f.write(json.dumps(sorted(a for m in messages if m for a in m.archives)).encode())

    def abort(self, messages):
        fs, root = open_store(self.path)
        for m in messages:
            for name, _ in m.archives if m else []:
                for path in (f"{root}/{name}", f"{root}/{name}.idx"):
                    if fs.get_file_info(path).type == pafs.FileType.File:
                        fs.delete_file(path)


class MediaSource(DataSource):
    @classmethod
    def name(cls):
        return "factloom_media"

    def schema(self):
        return "id long, n_bytes long, archive string, offset long, media binary, tries int, error string"

    def reader(self, schema):
        return MediaReader(self.options)

    def writer(self, schema, overwrite):
        return MediaWriter(self.options)


def write_media(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", archive_mb: float = 128) -> str:
    """Store every text's UTF-8 bytes as an image in archives under path; returns it."""
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("n_bytes", T.LongType()), T.StructField("media", T.BinaryType())])

    def run(slices):
        for rows in slices:
            out = []
            for r in rows:
                data = (r["text"] or "").encode("utf-8", "surrogatepass")
                out.append((r["id"], len(data), encode_png(padded(data), WIDTH)))
            yield out

    rows = map_rows(pick(docs, id=id_col, text=text_col).withColumn("id", F.col("id").cast("long")), run, schema)
    docs.sparkSession.dataSource.register(MediaSource)
    rows.write.format("factloom_media").mode("append").option("archive_mb", str(archive_mb)).save(path)
    return path


def read_media(spark: SparkSession, path: str, range_mb: float = 32) -> DataFrame:
    """id, n_bytes, archive, offset, media, tries, error for every member of the archives under path."""
    spark.dataSource.register(MediaSource)
    return spark.read.format("factloom_media").option("range_mb", str(range_mb)).load(path)


def media_columns(members: DataFrame) -> DataFrame:
    """Columns decoded from read_media's rows; an unreadable member raises, so no row goes missing."""
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("n_bytes", T.LongType()), T.StructField("payload_bytes", T.LongType()), T.StructField("payload_sha256", T.StringType()), T.StructField("tail_crc32", T.LongType()), T.StructField("media_bytes", T.LongType()), T.StructField("media_sha256", T.StringType()), T.StructField("feature", T.StringType())])

    def run(slices):
        for rows in slices:
            out = []
            for r in rows:
                if r["error"]:
                    raise OSError(f"member at {r['offset']} of {r['archive']}: {r['error']}")
                width, samples = decode_png(r["media"])
                out.append((r["id"], r["n_bytes"], len(samples), hashlib.sha256(samples).hexdigest(), zlib.crc32(samples[-TAIL:]), len(r["media"]), hashlib.sha256(r["media"]).hexdigest(), feature(samples, width)))
            yield out

    return map_rows(members, run, schema)


def round_trip(docs: DataFrame) -> DataFrame:
    """Store in the shared folder, read the stored bytes back, compute the columns."""
    spark = docs.sparkSession
    path = write_media(docs, fresh_path(spark, "media"))
    delete_at_exit(spark, path)
    return media_columns(read_media(spark, path))
