"""WARC records in seekable Zstandard bundles.

Records are grouped into independent Zstandard frames; a bundle (one file)
ends with a skippable frame that maps record identifiers to ``(frame, offset
in the frame, length)``, and with the seek table of the seekable Zstandard
format (compressed and full size of every frame, number of frames, magic). Any
decompressor reads the file from start to end; with the index one record costs
one frame.

The files are written and read by Spark itself, so they may lie in any store
Spark reaches: a bundle is one row, saved by the text writer as one file whose
"line end" is the last four bytes of the seek table, its magic. They are read
by the binary-file source.

Equal payloads of at least ``min_revisit`` bytes are stored once: the record
with the smallest id is ``response``, the others are ``revisit`` records
without payload that name it.

Scale: the digests are combined before they are shuffled (one row per digest
and task); pages meet them in a join on the digest, which Spark splits when a
payload is hot (one row per digest on the other side). A task holds one bundle.

Defined results: null html is the empty payload; a null url is stored without
target; rows that repeat an id are records of their own, each ``response`` if
the id is the smallest of its payload; a null id never is the smallest, but is
``response`` if its payload has no other id; an empty table makes no archive
and no rows; other columns are not archived.
"""

from __future__ import annotations

import hashlib
import json
import re
import struct
import uuid
from dataclasses import dataclass

import pyarrow as pa
import zstandard
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import scratch_path, table, utf8

# Fixed values of the seekable format: magic numbers, little-endian.
SEEK_FRAME = 0x184D2A5E
INDEX_FRAME = 0x184D2A51
SEEK_MAGIC = 0x8F92EAB1
MAGIC_TEXT = struct.pack("<I", SEEK_MAGIC).decode("latin-1")
#: Smallest payload that may be replaced by a revisit.
MIN_REVISIT = 100
FRAME_BYTES = 256 << 10
BUNDLE_BYTES = 8 << 20
DATE = "1970-01-01T00:00:00Z"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


# -- records ----------------------------------------------------------------


def header_value(text: str) -> str:
    """Control characters and blanks of a header value, percent-encoded."""
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", text)


def record_bytes(row: dict, identifier: str) -> bytes:
    """One WARC 1.1 record of a page."""
    revisit = row["record_type"] == "revisit"
    payload = row["payload"]
    head = [
        "WARC/1.1",
        f"WARC-Type: {row['record_type']}",
        f"WARC-Record-ID: <{identifier}>",
        f"WARC-Date: {DATE}",
        "Content-Type: application/http; msgtype=response",
        f"WARC-Payload-Digest: sha256:{row['payload_digest']}",
        f"X-Payload-Length: {len(payload)}",
    ]
    if row["url"] is not None:
        head.append(f"WARC-Target-URI: {header_value(row['url'])}")
    if row["page_id"] is not None:
        head.append(f"X-Page-ID: {row['page_id']}")
    if revisit:
        head += [f"WARC-Profile: {REVISIT_PROFILE}", f"X-Refers-To-Page-ID: {row['refers_to']}"]
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n" + (b"" if revisit else payload)
    head.append(f"Content-Length: {len(block)}")
    return ("\r\n".join(head) + "\r\n\r\n").encode() + block + b"\r\n\r\n"


def parse_record(raw: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields and payload of one record."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = dict(line.split(": ", 1) for line in lines[1:])
    block = rest[: int(fields["Content-Length"])]
    if fields["Content-Type"].startswith("application/http"):
        return fields, block.partition(b"\r\n\r\n")[2]
    return fields, block


# -- bundles ----------------------------------------------------------------


class BundleWriter:
    """Collects records into frames and closes them into one archive."""

    def __init__(self, name: str, level: int = 3):
        self.packer = zstandard.ZstdCompressor(level=level, write_checksum=True)
        self.frames: list[bytes] = []
        self.sizes: list[tuple[int, int]] = []
        self.index: dict[str, tuple[int, int, int]] = {}
        self.open, self.size = bytearray(), 0
        info = f"software: ledgerlake\r\nformat: WARC File Format 1.1\r\nbundle: {name}\r\n".encode()
        self.open += (
            f"WARC/1.1\r\nWARC-Type: warcinfo\r\nWARC-Record-ID: <urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, name)}>\r\n"
            f"WARC-Date: {DATE}\r\nContent-Type: application/warc-fields\r\nContent-Length: {len(info)}\r\n\r\n"
        ).encode() + info + b"\r\n\r\n"

    def add(self, identifier: str, record: bytes) -> None:
        if self.open and len(self.open) + len(record) > FRAME_BYTES:
            self.flush()
        self.index[identifier] = (len(self.sizes), len(self.open), len(record))
        self.open += record

    def flush(self) -> None:
        packed = self.packer.compress(bytes(self.open))
        self.frames.append(packed)
        self.sizes.append((len(packed), len(self.open)))
        self.size += len(packed)
        self.open = bytearray()

    def close(self) -> bytes:
        if self.open:
            self.flush()
        body = self.packer.compress(json.dumps(self.index).encode())
        self.frames.append(struct.pack("<II", INDEX_FRAME, len(body)) + body)
        self.sizes.append((len(body) + 8, 0))
        entries = b"".join(struct.pack("<II", *s) for s in self.sizes)
        tail = struct.pack("<IBI", len(self.sizes), 0, SEEK_MAGIC)
        self.frames.append(struct.pack("<II", SEEK_FRAME, len(entries) + len(tail)) + entries + tail)
        return b"".join(self.frames)


@dataclass
class Bundle:
    """Random access to the records of one archive."""

    raw: bytes

    def __post_init__(self):
        count, _, magic = struct.unpack("<IBI", self.raw[-9:])
        if magic != SEEK_MAGIC:
            raise ValueError("no seek table")
        at = len(self.raw) - 9 - 8 * count
        if struct.unpack("<II", self.raw[at - 8 : at]) != (SEEK_FRAME, 8 * count + 9):
            raise ValueError("broken seek table")
        self.sizes = [struct.unpack("<II", self.raw[at + 8 * k : at + 8 * k + 8]) for k in range(count)]
        self.starts = [0]
        for packed, _ in self.sizes:
            self.starts.append(self.starts[-1] + packed)
        body = self.raw[self.starts[-2] : self.starts[-1]]
        if struct.unpack("<I", body[:4])[0] != INDEX_FRAME:
            raise ValueError("no record index")
        self.index = json.loads(zstandard.ZstdDecompressor().decompress(body[8:]))
        self._last: tuple[int, bytes] = (-1, b"")

    def frame(self, k: int) -> bytes:
        if self._last[0] != k:
            raw = self.raw[self.starts[k] : self.starts[k + 1]]
            self._last = (k, zstandard.ZstdDecompressor().decompress(raw, max_output_size=self.sizes[k][1]))
        return self._last[1]

    def record(self, identifier: str) -> bytes:
        k, offset, length = self.index[identifier]
        return self.frame(k)[offset : offset + length]


# -- Spark jobs ---------------------------------------------------------------


def classified(pages: DataFrame, min_revisit: int = MIN_REVISIT) -> DataFrame:
    """``pages(page_id, url, html)`` with payload, digest, record type and the page a revisit refers to."""
    hashed = pages.select(
        F.col("page_id").cast("bigint").alias("page_id"), F.col("url"), utf8(F.col("html")).alias("payload")
    ).withColumn("payload_digest", F.sha2("payload", 256))
    # Only digests that several rows share matter; combined per task before the shuffle.
    first = (
        hashed.where(F.octet_length("payload") >= min_revisit)
        .groupBy("payload_digest")
        .agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n"))
        .where("n > 1")
        .drop("n")
    )
    joined = hashed.join(first, "payload_digest", "left")
    again = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    return joined.select(
        "page_id", "url", "payload", "payload_digest",
        F.when(again, "revisit").otherwise("response").alias("record_type"),
        F.when(again, F.col("first")).alias("refers_to"),
    )


def write_archives(records: DataFrame, path: str, bundle_bytes: int = BUNDLE_BYTES) -> None:
    """Write every record of ``records`` into bundles under ``path``."""

    def pack(batches):
        from pyspark import TaskContext

        part, number, writer, seen = TaskContext.get().partitionId(), 0, None, 0
        for batch in batches:
            for k in range(batch.num_rows):
                row = {name: column[k].as_py() for name, column in zip(batch.schema.names, batch.columns)}  # one payload at a time
                if writer is None:
                    writer = BundleWriter(f"bundle-{part:06d}-{number:06d}")
                identifier = f"urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{row['page_id']}|{row['payload_digest']}|{part}|{seen}')}"
                seen += 1
                writer.add(identifier, record_bytes(row, identifier))
                if writer.size >= bundle_bytes:
                    yield pa.RecordBatch.from_pydict({"bundle": [writer.close()]})
                    writer, number = None, number + 1
        if writer is not None:
            yield pa.RecordBatch.from_pydict({"bundle": [writer.close()]})

    bundles = records.mapInArrow(pack, "bundle binary")
    body = F.expr("substring(bundle, 1, octet_length(bundle) - 4)").cast("string")  # the writer adds the magic
    bundles.select(body.alias("value")).write.option("lineSep", MAGIC_TEXT).option("encoding", "ISO-8859-1").option(
        "maxRecordsPerFile", 1
    ).text(path)


READ = (
    "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint, url string, "
    "record_id string, archive string, frame int, frame_offset bigint, record_length bigint"
)


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """One row per page record of the archives under ``path``; payloads are checked against their digests."""

    def unpack(batches):
        for batch in batches:
            for content, archive in zip(batch.column("content"), batch.column("path")):
                raw = content.as_py()
                if not raw:
                    continue
                bundle = Bundle(raw)
                rows = []
                for identifier, (k, offset, length) in bundle.index.items():
                    fields, payload = parse_record(bundle.record(identifier))
                    digest = fields["WARC-Payload-Digest"].removeprefix("sha256:")
                    kind = fields["WARC-Type"]
                    if kind == "response" and hashlib.sha256(payload).hexdigest() != digest:
                        raise ValueError(f"digest of {identifier} in {archive} is wrong")
                    page, refers = fields.get("X-Page-ID"), fields.get("X-Refers-To-Page-ID")
                    rows.append((
                        None if page is None else int(page), int(fields["X-Payload-Length"]), digest, kind,
                        None if refers is None else int(refers), fields.get("WARC-Target-URI"), identifier,
                        archive.as_py(), k, offset, length,
                    ))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(c), t) for c, t in zip(zip(*rows), READ_TYPES)], names=READ_NAMES
                )

    try:
        files = spark.read.format("binaryFile").load(path).where(F.col("length") > 0).select("path", "content")
    except AnalysisException as e:
        if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return spark.createDataFrame([], READ)
    return files.mapInArrow(unpack, READ)


READ_NAMES = [c.split()[0] for c in READ.split(", ")]
READ_TYPES = [{"bigint": pa.int64(), "string": pa.string(), "int": pa.int32()}[c.split()[1]] for c in READ.split(", ")]


def op1(spark, sf_dir):
    path = scratch_path(spark, "warc")
    write_archives(classified(table(spark, sf_dir, "pages")), path)
    return read_archives(spark, path).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


ORACLE_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h, sha256(coalesce(html, '')) AS d FROM pages),
f AS (SELECT d, min(page_id) AS f FROM p WHERE octet_length(encode(h)) >= 100 GROUP BY d)
SELECT page_id, CAST(octet_length(encode(h)) AS BIGINT) AS payload_bytes, p.d AS payload_digest,
  CASE WHEN f.f IS NOT NULL AND page_id <> f.f THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN page_id <> f.f THEN f.f END AS refers_to
FROM p LEFT JOIN f ON p.d = f.d
"""
