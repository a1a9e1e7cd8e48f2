"""WARC records in seekable Zstandard bundles.

Records are grouped into independent Zstandard frames, frames into bundles. Each bundle ends with the seek table of the
public seekable format (a skippable frame that lists the frames' sizes), so one record is read by decompressing one
frame. Executors share only what Spark can write, so a bundle is a binary cell of a Parquet table, next to the index of
its records: id, frame and offset within the decompressed frame. Written to a file, a cell is a valid ``.warc.zst``.

Of records with equal payloads of some size, the one with the greatest id carries it and the others refer to it
(revisit records). A NULL payload is empty; a NULL id ranks before all others. Rows that repeat the greatest id are all
responses. Only the named columns are read, so other columns may have any name.
"""

from __future__ import annotations

import hashlib
import struct
from base64 import b32decode, b32encode
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from chargelake.llm.common import row_key
from chargelake.staging import fits_broadcast, scratch_path, staged

REVISIT_BYTES = 1000
FRAME_BYTES = 256 << 10
BUNDLE_BYTES = 4 << 20
LEVEL = 3
BUNDLES_PER_FILE = 16  # a reader's batch then holds a bounded number of bytes

# Fixed values of the seekable format and of WARC 1.1.
SKIPPABLE_MAGIC, SEEKABLE_MAGIC = 0x184D2A5E, 0x8F92EAB1
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
ENTRY = "array<struct<record_id:string,frame:int,offset:bigint>>"


def with_record_types(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", least: int = REVISIT_BYTES) -> DataFrame:
    """(id, url, payload, digest, refers_to) per row, all but the payload as text; ``refers_to`` only for revisits."""
    text = F.coalesce(F.col(payload_col).cast("string"), F.lit(""))
    rows = pages.select(
        F.col(id_col).alias("id"), F.col(url_col).cast("string").alias("url"), text.alias("payload"),
        F.sha1(text.cast("binary")).alias("digest"), row_key(F.col(id_col), text).alias("key"))
    sized = rows.select("id", "key", "digest", F.octet_length("payload").alias("bytes")).filter(F.col("bytes") >= least)
    sized = staged(sized, "digests")
    heads = sized.groupBy("digest", "bytes").agg(F.max("id").alias("head"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    revisits = sized.join(heads, ["digest", "bytes"]).filter(~F.col("id").eqNullSafe(F.col("head")))
    revisits = staged(revisits.select("key", F.col("head").cast("string").alias("refers_to")).distinct(), "revisits")
    found = rows.join(F.broadcast(revisits) if fits_broadcast(revisits) else revisits, "key", "left")
    return found.select(F.col("id").cast("string").alias("id"), "url", "payload", "digest", "refers_to")


def _name(record_id: str | None) -> str:
    return f"<urn:x-page:{record_id or ''}>"


def record_bytes(record_id: str | None, url: str | None, payload: bytes, digest: str, refers_to: str | None, date: str) -> bytes:
    """One WARC record. A revisit keeps the HTTP header, whose Content-Length is that of the payload."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if refers_to is not None else http + payload
    head = [
        "WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: {_name(record_id)}",
        f"WARC-Date: {date}", "WARC-Payload-Digest: sha1:" + b32encode(bytes.fromhex(digest)).decode(),
        "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}",
    ]
    if url is not None:
        head.append("WARC-Target-URI: " + quote(url, safe="!#$%&'()*+,/:;=?@[]~"))
    if refers_to is not None:
        head += [f"WARC-Refers-To: {_name(refers_to)}", f"WARC-Profile: {PROFILE}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


class BundleWriter:
    """Collects records; ``finish`` gives the bundle and its index."""

    def __init__(self) -> None:
        self.done, self.sizes, self.index, self.open = bytearray(), [], [], bytearray()
        self.packer = zstandard.ZstdCompressor(level=LEVEL)

    def add(self, record_id: str | None, record: bytes) -> None:
        self.index.append({"record_id": record_id, "frame": len(self.sizes), "offset": len(self.open)})
        self.open += record
        if len(self.open) >= FRAME_BYTES:
            self.close_frame()

    def close_frame(self) -> None:
        if self.open:
            frame = self.packer.compress(bytes(self.open))
            self.sizes.append((len(frame), len(self.open)))
            self.done += frame
            self.open = bytearray()

    def finish(self) -> tuple[bytes, list[dict]]:
        self.close_frame()
        table = b"".join(struct.pack("<II", *pair) for pair in self.sizes) + struct.pack("<IBI", len(self.sizes), 0, SEEKABLE_MAGIC)
        return bytes(self.done) + struct.pack("<II", SKIPPABLE_MAGIC, len(table)) + table, self.index


def frame_places(bundle: bytes) -> list[tuple[int, int, int]]:
    """(offset, compressed size, size) of each frame, from the footer."""
    count, _, magic = struct.unpack("<IBI", bundle[-9:])
    if magic != SEEKABLE_MAGIC:
        raise ValueError("no seek table at the end of the bundle")
    at, places = 0, []
    for packed, plain in struct.iter_unpack("<II", bundle[-9 - 8 * count : -9]):
        places.append((at, packed, plain))
        at += packed
    return places


def read_frame(bundle: bytes, place: tuple[int, int, int]) -> bytes:
    at, packed, plain = place
    return zstandard.ZstdDecompressor().decompress(bundle[at : at + packed], max_output_size=plain)


def parse_record(frame: bytes, at: int) -> tuple[dict, int]:
    """The record at a place of a decompressed frame, and where the next one begins."""
    end = frame.index(b"\r\n\r\n", at)
    lines = frame[at:end].decode().split("\r\n")
    fields = dict(line.split(": ", 1) for line in lines[1:])
    block = frame[end + 4 : end + 4 + int(fields["Content-Length"])]
    http, payload = block.split(b"\r\n\r\n", 1)
    size = int(http.rsplit(b"Content-Length: ", 1)[1])
    named = lambda field: (fields[field][len("<urn:x-page:") : -1] or None) if field in fields else None
    record = {
        "record_id": named("WARC-Record-ID"), "record_type": fields["WARC-Type"], "url": fields.get("WARC-Target-URI"),
        "payload_bytes": size, "refers_to": named("WARC-Refers-To"),
        "digest": fields["WARC-Payload-Digest"].removeprefix("sha1:"), "payload": payload,
    }
    return record, end + 4 + len(block) + 4


def checked(record: dict) -> dict:
    """The record with its digest in hexadecimal; a response's payload must agree with it."""
    digest = b32decode(record["digest"]).hex()
    if record["record_type"] == "response" and hashlib.sha1(record["payload"]).hexdigest() != digest:
        raise ValueError(f"the payload of record {record['record_id']} is damaged")
    return record | {"digest": digest}


def write_bundles(records: DataFrame, path: str, date: str = "1970-01-01T00:00:00Z") -> DataFrame:
    """Store bundles of the records (see ``with_record_types``) below ``path``: (bundle_id, data, entries)."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bundle_id, writer = TaskContext.get().partitionId() << 33, BundleWriter()

        def closed() -> pa.RecordBatch:
            data, index = writer.finish()
            entry = pa.list_(pa.struct([("record_id", pa.string()), ("frame", pa.int32()), ("offset", pa.int64())]))
            return pa.RecordBatch.from_arrays(
                [pa.array([bundle_id]), pa.array([data], pa.binary()), pa.array([index], entry)], names=["bundle_id", "data", "entries"])

        for batch in batches:
            for row in zip(*batch.columns, strict=True):
                own, url, payload, digest, refers_to = (cell.as_py() for cell in row)
                writer.add(own, record_bytes(own, url, payload.encode("utf-8", "replace"), digest, refers_to, date))
                if len(writer.done) >= BUNDLE_BYTES:
                    yield closed()
                    bundle_id, writer = bundle_id + 1, BundleWriter()
        if writer.index:
            yield closed()

    bundles = records.select("id", "url", "payload", "digest", "refers_to").mapInArrow(write, f"bundle_id bigint, data binary, entries {ENTRY}")
    bundles.write.option("maxRecordsPerFile", BUNDLES_PER_FILE).parquet(path)
    return records.sparkSession.read.schema(bundles.schema).parquet(path)


def read_bundles(bundles: DataFrame, payloads: bool = False) -> DataFrame:
    """All records of the bundles, each payload checked against its digest; the payloads themselves on request."""
    names = ["record_id", "record_type", "url", "payload_bytes", "digest", "refers_to", *["payload"] * payloads]
    kinds = {"payload_bytes": pa.int64(), "payload": pa.binary()}
    schema = "record_id string, record_type string, url string, payload_bytes bigint, digest string, refers_to string" + ", payload binary" * payloads

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for cell in batch.column(0):
                bundle = cell.as_py()
                for place in frame_places(bundle):
                    frame, at, found = read_frame(bundle, place), 0, []
                    while at < len(frame):
                        record, at = parse_record(frame, at)
                        found.append(checked(record))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([r[name] for r in found], kinds.get(name, pa.string())) for name in names], names=names)

    return bundles.select("data").mapInArrow(read, schema)


def record_index(bundles: DataFrame) -> DataFrame:
    """(record_id, bundle_id, frame, offset)."""
    return bundles.select("bundle_id", F.inline("entries"))


def fetch(bundles: DataFrame, ids: DataFrame) -> DataFrame:
    """Records by id (column ``record_id``) through the index; only the frames that hold them are decompressed."""
    wanted = record_index(bundles).join(ids.select("record_id").distinct(), "record_id")
    frames = wanted.groupBy("bundle_id", "frame").agg(F.collect_list("offset").alias("offsets"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data, frame, offsets in zip(*batch.columns, strict=True):
                bundle = data.as_py()
                plain = read_frame(bundle, frame_places(bundle)[frame.as_py()])
                found = [checked(parse_record(plain, at)[0]) for at in offsets.as_py()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r["record_id"] for r in found]), pa.array([r["record_type"] for r in found]), pa.array([r["payload"] for r in found], pa.binary())],
                    names=["record_id", "record_type", "payload"])

    joined = frames.join(bundles.select("bundle_id", "data"), "bundle_id").select("data", "frame", "offsets")
    return joined.mapInArrow(read, "record_id string, record_type string, payload binary")


def archive(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html") -> DataFrame:
    """Bundles of all rows, stored in the session's shared folder."""
    records = with_record_types(pages, id_col, url_col, payload_col)
    return write_bundles(records, scratch_path(pages.sparkSession, "bundles"))
