"""WARC records in seekable Zstandard bundles.

Records are grouped into frames that decompress on their own; a bundle ends with a
skippable frame that holds the sizes of all its frames (the public seekable
format), and an index gives every record's bundle, frame and offset in the frame.
Bundles are rows of a Parquet table, so they can lie in any store that Spark
writes to and are committed with its tasks; ``export`` also writes them as files.
"""

from __future__ import annotations

import hashlib
import os
import struct
import uuid
from collections.abc import Iterable, Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillwork.llm.common import saved, small_batches

#: Fixed values of the seekable format.
SKIPPABLE, SEEKABLE = 0x184D2A5E, 0x8F92EAB1
#: Bytes of records in a frame and compressed bytes in a bundle, after which the next one begins.
FRAME_BYTES = 1 << 20
BUNDLE_BYTES = 16 << 20
LEVEL = 3
#: Shorter payloads are always stored.
LEAST_REVISITED = 100
DATE = "2000-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

BUNDLES = "bundle string, data binary, records array<struct<id:bigint,frame:int,offset:bigint,length:bigint>>"


def name(id: int | None) -> str:
    return f"urn:page:{'' if id is None else id}"


def clean(value: str) -> str:
    """A header's value without line ends."""
    return " ".join(value.split())


def record(id, url, payload: bytes, digest: str, first) -> bytes:
    """One WARC record; ``first`` is the id of the response that a revisit refers to."""
    revisit = first is not None
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    head = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: <{name(id)}>",
        f"WARC-Date: {DATE}",
        f"WARC-Payload-Digest: sha256:{digest}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if url is not None:
        head.append(f"WARC-Target-URI: {clean(url)}")
    if revisit:
        head += [f"WARC-Refers-To: <{name(first)}>", f"WARC-Profile: {PROFILE}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def seek_table(frames: list[tuple[int, int]]) -> bytes:
    """The footer: compressed and plain size of every frame."""
    body = b"".join(struct.pack("<II", c, d) for c, d in frames)
    body += struct.pack("<IBI", len(frames), 0, SEEKABLE)
    return struct.pack("<II", SKIPPABLE, len(body)) + body


def read_seek_table(data: bytes) -> list[tuple[int, int, int]]:
    """(start, compressed size, plain size) of every frame of a bundle."""
    n, flags, magic = struct.unpack("<IBI", data[-9:])
    if magic != SEEKABLE:
        raise ValueError("no seek table")
    width = 12 if flags & 0x80 else 8
    at = len(data) - 9 - n * width
    out, start = [], 0
    for i in range(n):
        compressed, plain = struct.unpack_from("<II", data, at + i * width)
        out.append((start, compressed, plain))
        start += compressed
    return out


def frame(data: bytes, number: int) -> bytes:
    """One frame of a bundle, decompressed alone."""
    start, compressed, plain = read_seek_table(data)[number]
    return zstandard.ZstdDecompressor().decompress(data[start : start + compressed], max_output_size=plain)


class Bundler:
    """Collects records and gives out full bundles."""

    def __init__(self):
        self.compressor = zstandard.ZstdCompressor(level=LEVEL)
        self.clear()

    def clear(self):
        self.done, self.sizes, self.index = [], [], []
        self.open, self.open_bytes, self.bytes = [], 0, 0

    def close_frame(self):
        if self.open:
            plain = b"".join(self.open)
            packed = self.compressor.compress(plain)
            self.done.append(packed)
            self.sizes.append((len(packed), len(plain)))
            self.bytes += len(packed)
            self.open, self.open_bytes = [], 0

    def add(self, id, data: bytes) -> None:
        self.index.append({"id": id, "frame": len(self.done), "offset": self.open_bytes, "length": len(data)})
        self.open.append(data)
        self.open_bytes += len(data)
        if self.open_bytes >= FRAME_BYTES:
            self.close_frame()

    def bundle(self) -> tuple[bytes, list[dict]]:
        self.close_frame()
        out = b"".join([*self.done, seek_table(self.sizes)]), self.index
        self.clear()
        return out


def _batch(data: bytes, index: list[dict]) -> pa.RecordBatch:
    key = hashlib.sha256(data).hexdigest()[:32]
    kind = pa.list_(pa.struct([("id", pa.int64()), ("frame", pa.int32()), ("offset", pa.int64()), ("length", pa.int64())]))
    return pa.RecordBatch.from_arrays(
        [pa.array([key]), pa.array([data], pa.binary()), pa.array([index], kind)], names=["bundle", "data", "records"]
    )


def write_bundles(pages: DataFrame, path: str, id: str = "page_id", url: str = "url", payload: str = "html") -> None:
    """Write a record per row of ``pages`` to the bundle table at ``path``.

    Of rows with equal payloads of at least ``LEAST_REVISITED`` bytes, the one with
    the smallest id is a response and the others are revisits of it; rows that
    share that id are responses too, as a record cannot refer to itself.  Rows
    without an id are responses.  A null payload is empty.
    """
    small_batches(pages.sparkSession)
    body = F.coalesce(F.col(payload).cast("binary"), F.lit(b"").cast("binary"))
    rows = pages.select(
        F.col(id).cast("bigint").alias("id"), F.col(url).cast("string").alias("url"), body.alias("payload"),
        F.sha2(body, 256).alias("digest"),
    )
    long = rows.filter((F.octet_length("payload") >= LEAST_REVISITED) & F.col("id").isNotNull())
    first = saved(
        long.groupBy(F.col("digest").alias("d"))
        .agg(F.min("id").alias("first"), F.max("id").alias("last"))
        .filter(F.col("first") != F.col("last"))
        .drop("last"),
        "first",
    )
    asked = F.when((F.octet_length("payload") >= LEAST_REVISITED) & F.col("id").isNotNull(), F.col("digest"))
    marked = rows.withColumn("asked", asked).join(first, F.col("asked") == F.col("d"), "left").select(
        "id", "url", "payload", "digest", F.when(F.col("first") != F.col("id"), F.col("first")).alias("first")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bundler = Bundler()
        for batch in batches:
            for start in range(0, batch.num_rows, 64):
                for row in batch.slice(start, 64).to_pylist():
                    bundler.add(row["id"], record(row["id"], row["url"], row["payload"], row["digest"], row["first"]))
                    if bundler.bytes >= BUNDLE_BYTES:
                        yield _batch(*bundler.bundle())
        if bundler.index:
            yield _batch(*bundler.bundle())

    # One bundle a row group or so: bundles are compressed already and large.
    marked.mapInArrow(run, BUNDLES).write.option("compression", "uncompressed").mode("errorifexists").parquet(path)


def parse(data: bytes) -> dict:
    """Headers and block of one record."""
    head, _, rest = data.partition(b"\r\n\r\n")
    headers = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[: int(headers["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    headers["payload"] = payload
    headers["http"] = dict(line.split(": ", 1) for line in http.decode().split("\r\n")[1:])
    return headers


def id_of(value: str | None) -> int | None:
    digits = (value or "").strip("<>").rpartition(":")[2]
    return int(digits) if digits else None


READ = (
    "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint, "
    "bundle string, frame int, frame_offset bigint"
)


def read_one(records: Iterable[dict], data: bytes) -> Iterator[tuple]:
    """Records of a bundle by their places; a response's payload must have its digest."""
    table = read_seek_table(data)
    unpack = zstandard.ZstdDecompressor()
    number, plain = -1, b""
    for r in records:
        if r["frame"] != number:
            number = r["frame"]
            start, compressed, size = table[number]
            plain = unpack.decompress(data[start : start + compressed], max_output_size=size)
        got = parse(plain[r["offset"] : r["offset"] + r["length"]])
        digest = got["WARC-Payload-Digest"].removeprefix("sha256:")
        revisit = got["WARC-Type"] == "revisit"
        n = int(got["http"]["Content-Length"])
        if not revisit and (hashlib.sha256(got["payload"]).hexdigest() != digest or len(got["payload"]) != n):
            raise ValueError(f"record {got['WARC-Record-ID']} is damaged")
        yield id_of(got["WARC-Record-ID"]), n, digest, got["WARC-Type"], id_of(got.get("WARC-Refers-To")), r["frame"], r["offset"]


def read_bundles(bundles: DataFrame) -> DataFrame:
    """A row per record of a bundle table, read from the bundles through index and seek table."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int32(), pa.int64()]
        names = [f.split()[0] for f in READ.split(", ")]
        for batch in batches:
            for i in range(batch.num_rows):
                key, data, index = (batch.column(c)[i].as_py() for c in ("bundle", "data", "records"))
                rows = [(a, b, c, d, e, key, f, g) for a, b, c, d, e, f, g in read_one(index, data)]
                columns = list(zip(*rows))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)

    return bundles.select("bundle", "data", "records").mapInArrow(run, READ)


def record_index(bundles: DataFrame) -> DataFrame:
    """Where each record lies: id, bundle, frame, offset in the plain frame, length."""
    return bundles.select("bundle", F.explode("records").alias("r")).select("r.id", "bundle", "r.frame", "r.offset", "r.length")


def export(bundles: DataFrame, folder: str) -> DataFrame:
    """Write every bundle as ``<bundle>.warc.zst`` into a folder that all machines mount.

    A file appears under its name only when it is whole, and a bundle's name
    follows from its bytes, so tasks that run twice do no harm.
    """

    def run(batches):
        for batch in batches:
            written = []
            for i in range(batch.num_rows):
                key, data = batch.column("bundle")[i].as_py(), batch.column("data")[i].as_py()
                target = os.path.join(folder, f"{key}.warc.zst")
                part = f"{target}.{uuid.uuid4().hex}"
                with open(part, "wb") as file:
                    file.write(data)
                os.replace(part, target)
                written.append(target)
            yield pa.RecordBatch.from_arrays([pa.array(written, pa.string())], names=["file"])

    return bundles.select("bundle", "data").mapInArrow(run, "file string")
