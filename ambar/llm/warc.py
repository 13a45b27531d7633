"""WARC archives as seekable Zstandard bundles.

A bundle is a file of independent Zstandard frames, each with a group of whole WARC records, followed by two
skippable frames: an index that maps every record id to its frame and its offset within the uncompressed frame,
and the seek table of the Zstandard seekable format, whose footer ends the file. Any Zstandard reader can
decompress a bundle as a whole; a reader with the seek table fetches single records.

Equal payloads are stored once: of the pages with one digest, that with the largest page_id is a response record,
and the others are revisit records that refer to it. Digests are grouped with partial aggregation and joined back
by measured size, with hot digests spread over tasks, so neither an empty nor a much copied page gathers in one place.

Spark writes and commits the files itself, one row per bundle, so a lost executor leaves no half-written bundle.
Its text writer ends a row with a line separator; that is set to the last byte of the seek table's footer.

Defined results: a missing payload is empty; a missing url has no target header; a missing page_id is written
without an id and is a response only if no page with an id has its payload; rows that repeat page_id and payload
are alike, all response or all revisit; an empty table writes no bundles and reads as no rows; other columns are
ignored.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
import uuid

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ambar.llm.common import kept_once, map_batches, table
from ambar.operators.joins import sized_join
from ambar.session import checkpoint_dir

# Fixed values of the formats.
SEEK_MAGIC, SEEK_FRAME, INDEX_FRAME = 0x8F92EAB1, 0x184D2A5E, 0x184D2A50
WARC_DATE = "1970-01-01T00:00:00Z"  # pages have no date
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
CRLF = b"\r\n"

FRAME_BYTES = 1 << 20  # uncompressed bytes after which a frame is closed
BUNDLE_BYTES = 8 << 20  # compressed bytes after which a bundle is closed
NO_ID = -(2**63)
ENTRY = struct.Struct("<qIII")  # record id, frame, offset within the frame, length


def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def warc_record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool) -> bytes:
    """One record; a revisit has the HTTP headers of the full payload, but not the payload."""
    http = CRLF.join([b"HTTP/1.1 200 OK", b"Content-Type: text/html; charset=utf-8", b"Content-Length: %d" % len(payload), b"", b""])
    block = http if revisit else http + payload
    lines = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Date: {WARC_DATE}", f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>"]
    if url is not None:
        lines.append("WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url))
    lines.append(f"WARC-Payload-Digest: sha1:{digest_of(payload)}")
    if revisit:
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    lines += ["Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(lines).encode() + block + CRLF + CRLF


def parse_record(data: bytes) -> dict:
    """The fields of a record; the payload of a response is held against its length and digest."""
    head, _, rest = data.partition(CRLF + CRLF)
    version, *lines = head.decode().split("\r\n")
    fields = dict(line.split(": ", 1) for line in lines)
    block = rest[: int(fields["Content-Length"])]
    if version != "WARC/1.1" or len(block) != int(fields["Content-Length"]) or rest[len(block) :] != CRLF + CRLF:
        raise ValueError("not a WARC record")
    http, _, payload = block.partition(CRLF + CRLF)
    length = int(re.search(rb"Content-Length: (\d+)", http)[1])
    digest, kind = fields["WARC-Payload-Digest"].removeprefix("sha1:"), fields["WARC-Type"]
    if kind == "response" and (len(payload) != length or digest_of(payload) != digest):
        raise ValueError("a payload differs from its digest")
    number = lambda name: (lambda x: int(x) if x else None)(fields.get(name, "")[len("<urn:page:") : -1])
    return {
        "page_id": number("WARC-Record-ID"), "url": fields.get("WARC-Target-URI"), "payload_bytes": length, "payload_digest": digest,
        "record_type": kind, "refers_to": number("WARC-Refers-To"), "payload": payload if kind == "response" else None,
    }


class Bundle:
    """Frames and index of one bundle in the making."""

    def __init__(self, frame_bytes: int):
        self.compress, self.frame_bytes = zstandard.ZstdCompressor(level=3).compress, frame_bytes
        self.frames, self.sizes, self.entries, self.open, self.filled, self.size = [], [], [], [], 0, 0

    def add(self, record_id: int | None, record: bytes) -> None:
        self.entries.append(ENTRY.pack(NO_ID if record_id is None else record_id, len(self.frames), self.filled, len(record)))
        self.open.append(record)
        self.filled += len(record)
        if self.filled >= self.frame_bytes:
            self._close_frame()

    def _close_frame(self) -> None:
        data = b"".join(self.open)
        frame = self.compress(data)
        self.frames.append(frame)
        self.sizes.append((len(frame), len(data)))
        self.size += len(frame)
        self.open, self.filled = [], 0

    def close(self) -> bytes:
        if self.open:
            self._close_frame()
        entries = b"".join(self.entries)
        index = struct.pack("<II", INDEX_FRAME, len(entries)) + entries
        sizes = [*self.sizes, (len(index), 0)]
        seek = b"".join(struct.pack("<II", *s) for s in sizes) + struct.pack("<IBI", len(sizes), 0, SEEK_MAGIC)
        return b"".join([*self.frames, index, struct.pack("<II", SEEK_FRAME, len(seek)), seek])


def read_index(data: bytes) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int, int]]]:
    """From a bundle's end: (start, compressed size, size) of each frame, and (record id, frame, offset, length) of each record."""
    count, _, magic = struct.unpack_from("<IBI", data, len(data) - 9)
    if magic != SEEK_MAGIC:
        raise ValueError("no seek table")
    at, start, frames = len(data) - 9 - 8 * count, 0, []
    for compressed, size in struct.iter_unpack("<II", data[at : len(data) - 9]):
        frames.append((start, compressed, size))
        start += compressed
    index_at, index_size, _ = frames.pop()
    return frames, list(ENTRY.iter_unpack(data[index_at + 8 : index_at + index_size]))


def record_at(data: bytes, frame: tuple[int, int, int], offset: int, length: int) -> bytes:
    """One record, with only its frame decompressed."""
    start, compressed, size = frame
    return zstandard.ZstdDecompressor().decompress(data[start : start + compressed], max_output_size=size)[offset : offset + length]


def _bundles(frame_bytes: int, bundle_bytes: int):
    def run(batches):
        bundle = Bundle(frame_bytes)
        for batch in batches:
            payloads = batch.column("payload").to_pylist()
            for page_id, url, payload, keep in zip(batch.column("page_id").to_pylist(), batch.column("url").to_pylist(), payloads, batch.column("keep").to_pylist()):
                revisit = keep is not None and page_id != keep
                bundle.add(page_id, warc_record(page_id, url, payload, keep, revisit))
                if bundle.size >= bundle_bytes:
                    yield pa.RecordBatch.from_arrays([pa.array([bundle.close()[:-1]], pa.binary())], ["value"])
                    bundle = Bundle(frame_bytes)
        if bundle.entries:
            yield pa.RecordBatch.from_arrays([pa.array([bundle.close()[:-1]], pa.binary())], ["value"])

    return run


def write_archives(
    pages: DataFrame, path: str, payload: str = "html", min_bytes: int = 0, frame_bytes: int = FRAME_BYTES, bundle_bytes: int = BUNDLE_BYTES
) -> None:
    """A record per row of ``pages`` (page_id, url and a payload column) in bundles below ``path``.

    Payloads of fewer than ``min_bytes`` are all stored.
    """
    rows = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.coalesce(F.col(payload), F.lit("")).cast("binary").alias("payload"))
    rows = rows.withColumn("_digest", F.sha1("payload"))
    long_enough = rows.where(F.length("payload") >= min_bytes).groupBy("_digest").agg(F.max("page_id").alias("keep"), F.count("*").alias("n"))
    twice = kept_once(long_enough.where("n > 1"))
    joined = sized_join(rows, twice, ["_digest"], "left", rows_col="n").select("page_id", "url", "payload", "keep")
    out = map_batches(joined, _bundles(frame_bytes, bundle_bytes), "value binary")
    # The separator is the footer's last byte, which each row leaves out.
    last = chr(SEEK_MAGIC >> 24)
    out.select(F.col("value").cast("string")).write.option("maxRecordsPerFile", 1).option("encoding", "ISO-8859-1").option("lineSep", last).text(path)


def _bundle_files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").load(path).where("length > 0").select("path", "content")


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """The records of all bundles below ``path``, read frame by frame."""

    def run(batches):
        for batch in batches:
            for data in batch.column("content").to_pylist():
                frames, entries = read_index(data)
                by_frame: dict[int, list] = {}
                for entry in entries:
                    by_frame.setdefault(entry[1], []).append(entry)
                for k, own in by_frame.items():
                    start, compressed, size = frames[k]
                    plain = zstandard.ZstdDecompressor().decompress(data[start : start + compressed], max_output_size=size)
                    yield pa.RecordBatch.from_pylist([parse_record(plain[at : at + n]) for _, _, at, n in own], schema=RECORDS)

    return map_batches(_bundle_files(spark, path).select("content"), run, RECORD_FIELDS)


RECORDS = pa.schema([
    ("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
    ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary()),
])
RECORD_FIELDS = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary"


def record_index(spark: SparkSession, path: str) -> DataFrame:
    """Where each record is: ``record_id``, ``path``, ``frame``, ``frame_start``, ``frame_bytes``, ``offset``, ``length``."""

    def run(batches):
        for batch in batches:
            for name, data in zip(batch.column("path").to_pylist(), batch.column("content").to_pylist()):
                frames, entries = read_index(data)
                rows = [(None if i == NO_ID else i, name, k, frames[k][0], frames[k][1], at, n) for i, k, at, n in entries]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], ["record_id", "path", "frame", "frame_start", "frame_bytes", "offset", "length"])

    return map_batches(_bundle_files(spark, path), run, "record_id long, path string, frame long, frame_start long, frame_bytes long, offset long, length long")


def fetch(spark: SparkSession, path: str, ids: DataFrame) -> DataFrame:
    """The records whose id is in ``ids`` (record_id), with only their frames decompressed."""
    wanted = sized_join(record_index(spark, path), kept_once(ids.select("record_id").distinct()), ["record_id"], "left_semi")
    places = wanted.groupBy("path").agg(F.collect_list(F.struct("frame_start", "frame_bytes", "offset", "length")).alias("places"))
    files = _bundle_files(spark, path).join(places, "path").select("content", "places")

    def run(batches):
        for batch in batches:
            for data, own in zip(batch.column("content").to_pylist(), batch.column("places").to_pylist()):
                found = [record_at(data, (p["frame_start"], p["frame_bytes"], p["offset"] + p["length"]), p["offset"], p["length"]) for p in own]
                yield pa.RecordBatch.from_pylist([parse_record(r) for r in found], schema=RECORDS)

    return map_batches(files, run, RECORD_FIELDS)


def op6_warc(spark, sf_dir):
    """Writes all pages as archives, and returns what is read back from them."""
    pages = table(spark, sf_dir, "pages")
    path = f"{checkpoint_dir(spark)}/warc-{uuid.uuid4().hex}"
    write_archives(pages, path)
    return read_archives(spark, path).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


ORACLE = r"""
WITH p AS (SELECT page_id, coalesce(html, '') AS t, sha1(coalesce(html, '')) AS h FROM pages),
k AS (SELECT *, max(page_id) OVER (PARTITION BY t) AS keep FROM p),
bits AS (
  SELECT *, list_aggregate(list_transform(range(1, 41), lambda i: lpad(bin(instr('0123456789abcdef', h[i]) - 1), 4, '0')), 'string_agg', '') AS b FROM k)
SELECT page_id, octet_length(encode(t))::BIGINT AS payload_bytes,
  list_aggregate(list_transform(range(0, 32), lambda j: 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'[(b[5 * j + 1] || b[5 * j + 2] || b[5 * j + 3] || b[5 * j + 4] || b[5 * j + 5])::BITSTRING::INT + 1]), 'string_agg', '') AS payload_digest,
  CASE WHEN page_id IS DISTINCT FROM keep AND keep IS NOT NULL THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN page_id IS DISTINCT FROM keep THEN keep END AS refers_to
FROM bits
"""
