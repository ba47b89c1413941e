"""Web archives as seekable Zstandard bundles.

A bundle is a run of independent Zstandard frames with a few WARC records each, then two skippable
frames: the record map (record id, frame, offset and length inside the decompressed frame) and, as
a footer, the seek table of the public seekable format. Any Zstandard reader gives the plain WARC;
a reader that knows the footer decompresses just the frame that holds a record.

Bundles are rows of a Parquet table in the shared folder, so Spark's own writers and readers carry
them to any store, and a lost task leaves no half-written archive behind.
"""

from __future__ import annotations

import base64
import hashlib
import json
import struct
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stage, text_or_empty

#: Decompressed bytes after which a frame ends, and compressed bytes after which a bundle ends.
FRAME_BYTES = 256 << 10
BUNDLE_BYTES = 4 << 20
#: Fixed values of the seekable format: skippable frame and seek table magics.
_SKIPPABLE_MAP = 0x184D2A50
_SKIPPABLE_SEEK = 0x184D2A5E
_SEEK_FOOTER = 0x8F92EAB1

RECORD_SCHEMA = (
    "page_id {id}, url string, record_type string, refers_to {id}, "
    "payload_bytes long, payload_digest string, payload binary")


def with_roles(pages: DataFrame, min_payload: int = 0) -> DataFrame:
    """Pages as rows to archive: of equal payloads the one with the largest page_id is ``response``,
    the others ``revisit`` it; payloads of fewer bytes than ``min_payload`` are all ``response``.

    A null html is an empty payload. Rows that repeat the largest page_id are all ``response``; a
    null page_id is smaller than any other, and a group of nulls alone is all ``response``.
    """
    payload = text_or_empty("html").cast("binary")
    rows = pages.select("page_id", F.col("url").cast("string"), payload.alias("payload")).select(
        "*", F.octet_length("payload").cast("long").alias("payload_bytes"), F.sha1("payload").alias("sha1"))
    repeated = (
        rows.filter(F.col("payload_bytes") >= min_payload)
        .groupBy("sha1", "payload_bytes").agg(F.max("page_id").alias("newest"), F.count("*").alias("__n"))
        .filter("__n > 1").drop("__n"))
    revisits = F.col("newest").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("newest"))
    return rows.join(repeated, ["sha1", "payload_bytes"], "left").select(
        "page_id", "url", "sha1", "payload_bytes",
        F.when(revisits, F.col("newest")).alias("refers_to"),
        F.when(~revisits, F.col("payload")).alias("payload"))


def _record_id(page_id, digest: str) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}:{digest}>"


def _record(page_id, url, sha1: str, size: int, refers_to, payload: bytes | None) -> tuple[str, bytes]:
    digest = base64.b32encode(bytes.fromhex(sha1)).decode()
    name = _record_id(page_id, digest)
    if refers_to is None:
        http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
        kind, block, more = "response", http + payload, []
    else:
        kind, block = "revisit", b""
        more = [f"WARC-Refers-To: {_record_id(refers_to, digest)}",
                "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    if url is not None:
        more.append("WARC-Target-URI: " + quote(url, safe="!#$%&'()*+,/:;=?@[]~"))
    head = "\r\n".join([
        "WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: {name}", "WARC-Date: 1970-01-01T00:00:00Z",
        f"WARC-Payload-Digest: sha1:{digest}", f"X-Payload-Length: {size}", *more,
        "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"])
    return name, head.encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


class _Bundle:
    def __init__(self):
        self.body, self.seek, self.map = bytearray(), [], []
        self.frame, self.named = bytearray(), []

    def add(self, name: str, record: bytes) -> None:
        self.named.append((name, len(self.seek), len(self.frame), len(record)))
        self.frame += record
        if len(self.frame) >= FRAME_BYTES:
            self.end_frame()

    def end_frame(self) -> None:
        if self.frame:
            packed = zstandard.ZstdCompressor(level=3).compress(bytes(self.frame))
            self.seek.append((len(packed), len(self.frame)))
            self.body += packed
            self.map += self.named
            self.frame, self.named = bytearray(), []

    def ended(self) -> bytes:
        self.end_frame()
        names = zstandard.ZstdCompressor().compress(json.dumps(self.map).encode())
        table = b"".join(struct.pack("<II", *entry) for entry in self.seek)
        table += struct.pack("<IBI", len(self.seek), 0, _SEEK_FOOTER)
        return bytes(
            self.body + struct.pack("<II", _SKIPPABLE_MAP, len(names)) + names
            + struct.pack("<II", _SKIPPABLE_SEEK, len(table)) + table)


class BundleReader:
    """Random access to one bundle by record id, through its footer."""

    def __init__(self, content: bytes):
        self.content = memoryview(content)
        n, _, magic = struct.unpack("<IBI", self.content[-9:])
        if magic != _SEEK_FOOTER:
            raise ValueError("the bundle has no seek table")
        table = len(content) - 9 - 8 * n
        sizes = list(struct.iter_unpack("<II", self.content[table:-9]))
        self.frames, at = [], 0
        for packed, plain in sizes:
            self.frames.append((at, packed, plain))
            at += packed
        magic, length = struct.unpack("<II", self.content[at:at + 8])
        if magic != _SKIPPABLE_MAP:
            raise ValueError("the bundle has no record map")
        self.map = json.loads(zstandard.ZstdDecompressor().decompress(self.content[at + 8:at + 8 + length]))

    def frame(self, k: int) -> bytes:
        at, packed, plain = self.frames[k]
        return zstandard.ZstdDecompressor().decompress(self.content[at:at + packed], max_output_size=plain)

    def records(self, wanted: set[str] | None = None) -> Iterator[bytes]:
        """All records, or those of the wanted ids; each frame that holds one is decompressed once."""
        open_frame, plain = -1, b""
        for name, k, offset, length in self.map:
            if wanted is None or name in wanted:
                if k != open_frame:
                    open_frame, plain = k, self.frame(k)
                yield plain[offset:offset + length]


def parse_record(record: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields and payload of one record; a response's digest and lengths are verified."""
    head, _, rest = record.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[:int(fields["Content-Length"])]
    payload = b""
    if fields["WARC-Type"] == "response":
        payload = block.partition(b"\r\n\r\n")[2]
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        if f"sha1:{digest}" != fields["WARC-Payload-Digest"] or len(payload) != int(fields["X-Payload-Length"]):
            raise ValueError(f"record {fields['WARC-Record-ID']} does not hold its payload")
    return fields, payload


def write_bundles(rows: DataFrame) -> DataFrame:
    """Archive the rows of ``with_roles``; returns the bundle table (``bundle_id``, ``content``), written
    to the shared folder. A task holds one open bundle at a time."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def row(bundle: _Bundle) -> pa.RecordBatch:
            content = bundle.ended()
            return pa.RecordBatch.from_pydict(
                {"bundle_id": [hashlib.sha256(content).hexdigest()[:32]], "content": pa.array([content], pa.binary())})

        bundle = _Bundle()
        for batch in batches:
            for cells in zip(*(c for c in batch.columns)):
                bundle.add(*_record(*(c.as_py() for c in cells)))
                if len(bundle.body) >= BUNDLE_BYTES:
                    yield row(bundle)
                    bundle = _Bundle()
        if bundle.map or bundle.named:
            yield row(bundle)

    ordered = rows.select("page_id", "url", "sha1", "payload_bytes", "refers_to", "payload")
    return stage(ordered.mapInArrow(pack, "bundle_id string, content binary"), "warc")


def read_bundles(bundles: DataFrame, id_type: str = "bigint", payloads: bool = True, wanted: set[str] | None = None) -> DataFrame:
    """Read bundles back, one row per record. ``wanted`` (record ids) reads the frames that hold them alone."""

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole = int if id_type in ("bigint", "int", "smallint", "tinyint") else str
        page = lambda name: whole(p) if (p := name.removeprefix("<urn:page:").rpartition(":")[0]) else None
        for batch in batches:
            for content in batch.column(0):
                out, held = [], 0
                for fields, payload in map(parse_record, BundleReader(content.as_py()).records(wanted)):
                    refers = fields.get("WARC-Refers-To")
                    out.append({
                        "page_id": page(fields["WARC-Record-ID"]), "url": fields.get("WARC-Target-URI"),
                        "record_type": fields["WARC-Type"], "refers_to": page(refers) if refers else None,
                        "payload_bytes": int(fields["X-Payload-Length"]),
                        "payload_digest": fields["WARC-Payload-Digest"].removeprefix("sha1:"),
                        "payload": payload if payloads and fields["WARC-Type"] == "response" else None})
                    held += len(payload) if payloads else 0
                    if held > 8 << 20 or len(out) >= 4096:
                        yield pa.RecordBatch.from_pylist(out, schema)
                        out, held = [], 0
                if out:
                    yield pa.RecordBatch.from_pylist(out, schema)

    spark_schema = RECORD_SCHEMA.format(id=id_type)
    arrow = {"bigint": pa.int64(), "int": pa.int32(), "smallint": pa.int16(), "tinyint": pa.int8()}.get(id_type, pa.string())
    schema = pa.schema([
        ("page_id", arrow), ("url", pa.string()), ("record_type", pa.string()), ("refers_to", arrow),
        ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("payload", pa.binary())])
    return bundles.select("content").mapInArrow(unpack, spark_schema)
