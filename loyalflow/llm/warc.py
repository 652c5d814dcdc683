"""Operator 8, WARC: seekable Zstandard bundles.

Each task writes its records to bundles in the shared folder. A bundle is a row of independent Zstandard frames of some
records each, and ends with the seekable format's table of frame sizes in a skippable frame, so that a reader finds any
frame from the file's end and unpacks only that. The writer returns the index: record identifier, bundle, frame, offset
in the unpacked frame and length. A retried task may get its rows in another order, so each attempt has bundles of its own;
the index, committed by Spark, names those of the attempt that counts, and readers take no others.

Payloads of MIN_REVISIT bytes and more that occur more than once are stored once, under the largest identifier; the other
records are revisits that name it.
"""

from __future__ import annotations

import hashlib
import os
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loyalflow.llm.shared import scratch_path, spread_join, tasks

MIN_REVISIT = 1000
FRAME_BYTES, BUNDLE_BYTES = 1 << 18, 1 << 26
#: Fixed values of the seekable format.
SKIPPABLE, SEEKABLE = 0x184D2A5E, 0x8F92EAB1
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
INDEX = "record_id string, page_id long, bundle string, frame int, offset long, length long"


def record_id(page_id: int | None, digest: str) -> str:
    return f"urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}:{digest}')}"


def build_record(page_id: int | None, url: str | None, payload: bytes, digest: str, kind: str, refers_to: int | None) -> bytes:
    """One WARC/1.1 record. The page's identifier, the payload's length and a revisit's page stand in headers of their own."""
    body = HTTP if kind == "revisit" else HTTP + payload
    heads = [("WARC-Type", kind), ("WARC-Record-ID", f"<{record_id(page_id, digest)}>"), ("WARC-Date", "1970-01-01T00:00:00Z")]
    heads += [("WARC-Target-URI", "".join(c for c in url if c.isprintable()))] if url else []
    heads += [("WARC-Payload-Digest", f"sha1:{digest}"), ("X-Page-ID", "" if page_id is None else str(page_id)), ("X-Payload-Length", str(len(payload)))]
    if kind == "revisit":
        heads += [("WARC-Profile", PROFILE), ("WARC-Refers-To", f"<{record_id(refers_to, digest)}>"), ("X-Refers-To-Page", str(refers_to))]
    heads += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(body)))]
    return b"WARC/1.1\r\n" + b"".join(f"{k}: {v}\r\n".encode() for k, v in heads) + b"\r\n" + body + b"\r\n\r\n"


def parse_record(data: bytes, at: int) -> tuple[dict[str, str], bytes, int]:
    """Headers and payload of the record at ``at``, and where the next one begins."""
    end = data.index(b"\r\n\r\n", at)
    version, *lines = data[at:end].decode().split("\r\n")
    if version != "WARC/1.1":
        raise ValueError(f"no record at {at}")
    heads = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in lines)
    size = int(heads["Content-Length"])
    block = data[end + 4 : end + 4 + size]
    return heads, block[block.index(b"\r\n\r\n") + 4 :], end + 4 + size + 4


def seek_table(frames: list[tuple[int, int]]) -> bytes:
    """frames: packed and unpacked size of each."""
    rows = b"".join(struct.pack("<II", *f) for f in frames)
    return struct.pack("<II", SKIPPABLE, len(rows) + 9) + rows + struct.pack("<IBI", len(frames), 0, SEEKABLE)


class Bundle:
    """Reads a bundle by frames."""

    def __init__(self, uri: str):
        fs, path = pafs.FileSystem.from_uri(uri)
        self.file = fs.open_input_file(path)
        size = self.file.size()
        self.file.seek(size - 9)
        count, flags, magic = struct.unpack("<IBI", self.file.read(9))
        if magic != SEEKABLE or flags:
            raise ValueError(f"{uri} has no seek table")
        self.file.seek(size - 9 - 8 * count)
        sizes = list(struct.iter_unpack("<II", self.file.read(8 * count)))
        self.frames, at = [], 0
        for packed, unpacked in sizes:
            self.frames.append((at, packed, unpacked))
            at += packed

    def frame(self, i: int) -> bytes:
        at, packed, unpacked = self.frames[i]
        self.file.seek(at)
        return zstandard.ZstdDecompressor().decompress(self.file.read(packed), max_output_size=unpacked)

    def record(self, frame: int, offset: int) -> tuple[dict[str, str], bytes]:
        return parse_record(self.frame(frame), offset)[:2]


class _Writer:
    def __init__(self, folder: str, name: str):
        self.fs, self.folder = pafs.FileSystem.from_uri(folder)
        self.name, self.bundles, self.out = name, 0, None

    def open(self) -> None:
        self.path = f"{self.folder}/{self.name}-{self.bundles:05d}.warc.zst"
        self.draft = f"{self.folder}/.draft-{uuid.uuid4().hex}"  # of this attempt
        self.out, self.frames, self.buffer, self.size, self.index = self.fs.open_output_stream(self.draft), [], b"", 0, []

    def add(self, page_id: int | None, digest: str, record: bytes) -> None:
        if self.out is None:
            self.open()
        self.index.append((record_id(page_id, digest), page_id, len(self.frames), len(self.buffer), len(record)))
        self.buffer += record
        if len(self.buffer) >= FRAME_BYTES:
            self.frame()

    def frame(self) -> None:
        if self.buffer:
            packed = zstandard.ZstdCompressor(level=3).compress(self.buffer)
            self.out.write(packed)
            self.frames.append((len(packed), len(self.buffer)))
            self.size, self.buffer = self.size + len(packed), b""

    def full(self) -> bool:
        return self.out is not None and self.size >= BUNDLE_BYTES

    def close(self) -> pa.RecordBatch:
        self.frame()
        self.out.write(seek_table(self.frames))
        self.out.close()
        self.fs.move(self.draft, self.path)
        self.out, self.bundles = None, self.bundles + 1
        ids, pages, frames, offsets, sizes = zip(*self.index, strict=True)
        return pa.RecordBatch.from_arrays([pa.array(ids), pa.array(pages, pa.int64()), pa.array([os.path.basename(self.path)] * len(ids)), pa.array(frames, pa.int32()), pa.array(offsets, pa.int64()), pa.array(sizes, pa.int64())], ["record_id", "page_id", "bundle", "frame", "offset", "length"])


def classified(pages: DataFrame) -> DataFrame:
    """page_id, url, html (null: empty), payload_digest, record_type, refers_to.

    Equal payloads under one largest page_id: its rows are responses (both, if the row is repeated), other rows are
    revisits; a null page_id is the smallest."""
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.encode(F.coalesce(F.col("html").cast("string"), F.lit("")), "utf-8").alias("html"))
    rows = rows.withColumn("payload_digest", F.sha1("html"))
    rows = rows.withColumn("_large", F.when(F.octet_length("html") >= MIN_REVISIT, F.col("payload_digest")))  # small payloads: null, which meets nothing
    keep = rows.where("_large is not null").groupBy("_large").agg(F.max("page_id").alias("keep_id"), F.count(F.lit(1)).alias("n")).where("n > 1 and keep_id is not null").drop("n")
    rows = spread_join(rows, keep, ["_large"], F.col("page_id"))
    other = F.col("keep_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("keep_id"))
    return rows.select("page_id", "url", "html", "payload_digest", F.when(other, "revisit").otherwise("response").alias("record_type"), F.when(other, F.col("keep_id")).alias("refers_to"))


def write_bundles(pages: DataFrame, folder: str) -> DataFrame:
    """Write a record of each row of ``pages`` (page_id, url, html; other columns are ignored) under ``folder``, a URI that all
    executors reach; returns the index, read from where it was written beside the bundles."""
    spark = pages.sparkSession
    to = f"{folder}/bundles"
    fs, path = pafs.FileSystem.from_uri(to)
    fs.create_dir(path, recursive=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task = TaskContext.get()
        writer = _Writer(to, f"part-{task.partitionId():06d}-{task.taskAttemptId()}")
        for b in batches:
            for page_id, url, html, digest, kind, refers in zip(*(b.column(i) for i in range(6)), strict=True):
                page, sha = page_id.as_py(), digest.as_py()
                writer.add(page, sha, build_record(page, url.as_py(), html.as_py(), sha, kind.as_py(), refers.as_py()))
                if writer.full():
                    yield writer.close()
        if writer.out is not None:
            yield writer.close()

    classified(pages).mapInArrow(run, INDEX).write.parquet(f"{folder}/index")
    return spark.read.schema(INDEX).parquet(f"{folder}/index")


def read_bundles(spark: SparkSession, folder: str) -> DataFrame:
    """All records of the bundles, by the index: page_id, record_type, payload_bytes, payload_digest, refers_to.

    Each frame is unpacked once, where its records are read; a response's length and digest are worked out from its
    payload and must be those in its headers. Only bundles that the index names count."""
    index = spark.read.schema(INDEX).parquet(f"{folder}/index")
    frames = index.groupBy("bundle", "frame").agg(F.sort_array(F.collect_list("offset")).alias("offsets"))  # a frame has FRAME_BYTES or one record
    schema = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bundle, name = None, None
        for b in batches:
            for own, i, offsets in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if own != name:
                    bundle, name = Bundle(f"{folder}/bundles/{own}"), own
                data, rows = bundle.frame(i), []
                for at in offsets:
                    heads, body, _ = parse_record(data, at)
                    size, digest = int(heads["X-Payload-Length"]), heads["WARC-Payload-Digest"].removeprefix("sha1:")
                    revisit = heads["WARC-Type"] == "revisit"
                    if not revisit and (size, digest) != (len(body), hashlib.sha1(body).hexdigest()):
                        raise ValueError(f"record at {at} in frame {i} of {own} is damaged")
                    page = heads["X-Page-ID"]
                    rows.append((int(page) if page else None, size, digest, "revisit" if revisit else "response", int(heads["X-Refers-To-Page"]) if revisit else None))
                kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds)], ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"])

    return frames.repartition(tasks(spark), "bundle", "frame").sortWithinPartitions("bundle", "frame").mapInArrow(run, schema)


def op8_warc_bundles(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_path(spark, "warc")
    write_bundles(spark.read.parquet(f"{sf_dir}/pages.parquet"), folder)
    return read_bundles(spark, folder)


QUERIES = {"op8_warc_bundles": op8_warc_bundles}
ORACLE_SQL = {
    "op8_warc_bundles": """
        WITH payloads AS (
            SELECT page_id, octet_length(encode(coalesce(html, '')))::BIGINT AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest
            FROM pages),
        named AS (
            SELECT *, CASE WHEN payload_bytes >= 1000 THEN max(page_id) OVER (PARTITION BY payload_digest) END AS keep_id
            FROM payloads)
        SELECT page_id, payload_bytes, payload_digest,
               CASE WHEN keep_id <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN keep_id <> page_id THEN keep_id END AS refers_to
        FROM named
    """,
}
