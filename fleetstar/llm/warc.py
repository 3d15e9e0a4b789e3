"""Legacy archive converter: ARC files to WARC files, and both ways of reading.

ARC: each file opens with a version block that names its version and header
line; a record is one header line (version 1: URL, address, date, type,
length; version 2 adds result code, checksum, location, offset and file name
before the length) and as many bytes as that line declares. Fields are taken
from the right, so a URL may hold spaces. A new version block may occur
anywhere and holds from there on.

WARC: identifiers, dates, types and digests are synthesised from the ARC
records. Of records with equal payloads (at least ``min_bytes`` long) the one
with the smallest page id is the response; the others are revisits that refer
to it, with the HTTP header but no payload.

Files are written and read by Spark, in the shared folder, in two size
classes: pages of up to ``LARGE_BYTES`` lie ``FILE_RECORDS`` to a file, larger
ones in a file each. So a file, which is one row when it is read, holds about
``FILE_RECORDS * LARGE_BYTES`` bytes or a single page. Only
ids and digests are shuffled by digest (pre-aggregated; the few-column join
back splits hot digests), and whole compressed files by path.

Edge cases: a null payload is empty; a null URL is ``-``; a null page id is
always a response and never referred to; rows that repeat the smallest id are
all responses; empty tables give empty archives; other columns are ignored.
A damaged record (bad header, short content, digest mismatch) raises.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Callable, Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetstar.session import scratch_path

from .common import materialise

FILE_RECORDS = 1000
LARGE_BYTES = 256 << 10
FIELDS = {1: "URL IP-address Archive-date Content-type Archive-length",
          2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length"}
CAPTURED = "20240101000000"
RECORD_SPACE = uuid.UUID("6f1c5d1e-0b7a-4c58-0000-000000000000").int


class ArcRecord(NamedTuple):
    version: int
    url: str
    address: str
    date: str
    mime: str
    content: bytes


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(page_id: int) -> str:
    return uuid.UUID(int=RECORD_SPACE | page_id % (1 << 64)).urn


def page_of(urn: str) -> int:
    low = uuid.UUID(urn).int & ((1 << 64) - 1)
    return low - (1 << 64) if low >> 63 else low


def arc_header(version: int, url: str, address: str, date: str, mime: str, length: int) -> bytes:
    more = " 200 - - 0 pages.arc" if version == 2 else ""
    return f"{url} {address} {date} {mime}{more} {length}".encode()


def version_block(version: int) -> bytes:
    body = f"{version} 0 pages\n{FIELDS[version]}\n".encode()
    return f"filedesc://pages.arc 0.0.0.0 {CAPTURED} text/plain {len(body)}".encode() + b"\n" + body


def read_arc(data: bytes) -> Iterator[ArcRecord]:
    """The records of an uncompressed ARC file, by declared lengths."""
    at, version = 0, 0
    while at < len(data):
        if data[at:at + 1] == b"\n":  # separator after each record
            at += 1
            continue
        end = data.find(b"\n", at)
        line = data[at:end if end >= 0 else len(data)].decode()
        block = line.startswith("filedesc://")
        if not block and version not in FIELDS:
            raise ValueError(f"ARC record before any version block: {line[:80]!r}")
        parts = line.rsplit(" ", 4 if block else len(FIELDS[version].split()) - 1)
        if end < 0 or len(parts) < 5 or not parts[-1].isdigit() or end + 1 + int(parts[-1]) > len(data):
            raise ValueError(f"damaged ARC record: {line[:80]!r}")
        content = data[end + 1:end + 1 + int(parts[-1])]
        at = end + 1 + len(content)
        if block:
            version = int(content.split(b" ", 1)[0])
            continue
        yield ArcRecord(version, parts[0], parts[1], parts[2], parts[3], content)


def split_http(content: bytes) -> tuple[bytes, bytes]:
    """(HTTP header with its blank line, payload); content without one is all payload."""
    end = content.find(b"\r\n\r\n")
    return (content[:end + 4], content[end + 4:]) if content.startswith(b"HTTP/") and end >= 0 else (b"", content)


def http_field(head: bytes, name: str) -> str | None:
    for line in head.decode().split("\r\n")[1:]:
        key, _, value = line.partition(": ")
        if key == name:
            return value
    return None


def warc_record(kind: str, fields: list[tuple[str, str]], block: bytes, content_type: str) -> bytes:
    """A record without its closing CRLF CRLF, which the writer adds."""
    lines = [("WARC-Type", kind), *fields, ("WARC-Block-Digest", f"sha1:{digest(block)}"),
             ("Content-Type", content_type), ("Content-Length", str(len(block)))]
    return b"WARC/1.0\r\n" + "".join(f"{k}: {v}\r\n" for k, v in lines).encode() + b"\r\n" + block


def to_warc(record: ArcRecord, refers_to: int | None = None) -> bytes:
    head, payload = split_http(record.content)
    page = http_field(head, "X-Page-Id")
    name = record_id(int(page)) if page else uuid.uuid5(uuid.NAMESPACE_URL, f"{record.url} {record.date}").urn
    d = record.date
    fields = [("WARC-Record-ID", f"<{name}>"),
              ("WARC-Date", f"{d[:4]}-{d[4:6]}-{d[6:8]}T{d[8:10]}:{d[10:12]}:{d[12:14]}Z"),
              ("WARC-Target-URI", record.url), ("WARC-IP-Address", record.address),
              ("WARC-Payload-Digest", f"sha1:{digest(payload)}")]
    if refers_to is None:
        return warc_record("response", fields, record.content, "application/http; msgtype=response")
    fields += [("WARC-Refers-To", f"<{record_id(refers_to)}>"),
               ("WARC-Profile", "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest")]
    return warc_record("revisit", fields, head, "application/http; msgtype=response")


def read_warc(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(header fields, block) of each record of an uncompressed WARC file, by declared lengths."""
    at = 0
    while at < len(data):
        end = data.find(b"\r\n\r\n", at)
        lines = data[at:end].decode().split("\r\n")
        if end < 0 or not lines[0].startswith("WARC/"):
            raise ValueError(f"damaged WARC record at byte {at}")
        fields = dict(line.split(": ", 1) for line in lines[1:])
        block = data[end + 4:end + 4 + int(fields["Content-Length"])]
        at = end + 4 + len(block)
        if data[at:at + 4] != b"\r\n\r\n" or fields["WARC-Block-Digest"] != f"sha1:{digest(block)}":
            raise ValueError(f"damaged WARC record {fields.get('WARC-Record-ID')}")
        at += 4
        yield fields, block


def gunzip(data: bytes) -> bytes:
    """All members of a gzip file."""
    out = []
    while data:
        member = zlib.decompressobj(31)
        out += [member.decompress(data), member.flush()]
        data = member.unused_data
    return b"".join(out)


def _classes() -> dict[str, int]:
    """Rows of a file by size class: a file's own head row and its records."""
    return {"small": FILE_RECORDS, "large": 2}


def _write(records: DataFrame, path: str, separator: str, per_file: int) -> None:
    """One archive per task and ``per_file`` rows; bytes are written as they are."""
    (records.select(F.col("record").cast("string")).write.option("lineSep", separator).option("compression", "gzip")
     .option("zlib.compress.level", "BEST_SPEED").option("maxRecordsPerFile", per_file).text(path))


def _files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").option("recursiveFileLookup", True).load(path).select("path", "content")


def _rows(schema: pa.Schema, rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def write_arc(pages: DataFrame) -> str:
    """Write each page as an ARC record, in files of alternating versions; returns the folder,
    with a folder for each size class in it."""
    path = scratch_path(pages.sparkSession, "arc")
    large = F.coalesce(F.octet_length("html") > LARGE_BYTES, F.lit(False))
    for name, per_file in _classes().items():
        rows = pages.where(large if name == "large" else ~large).select("page_id", "url", "html")
        _write(rows.mapInArrow(_arc_rows(per_file), "record binary"), f"{path}/{name}", "\n", per_file)
    return path


def _arc_rows(per_file: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    schema = pa.schema([("record", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, n = TaskContext.get().partitionId(), 0
        for batch in batches:
            rows = []
            for page_id, url, html in zip(*(batch.column(i).to_pylist() for i in range(3))):
                if n % per_file == 0:  # the first record of each file
                    version = 1 + (task + n // per_file) % 2
                    rows.append((version_block(version),))
                    n += 1
                payload = (html or "").encode()
                name = f"X-Page-Id: {page_id}\r\n" if page_id is not None else ""
                content = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n{name}"
                           f"Content-Length: {len(payload)}\r\n\r\n").encode() + payload
                clean = " ".join((url or "-").split()) or "-"
                rows.append((arc_header(version, clean, "0.0.0.0", CAPTURED, "text/html", len(content)) + b"\n" + content,))
                n += 1
            if rows:
                yield _rows(schema, rows)

    return run


def arc_payloads(arc: DataFrame) -> DataFrame:
    """path, place in the file, page_id, payload_bytes and digest of every ARC record."""
    schema = pa.schema([("path", pa.string()), ("n", pa.int32()), ("page_id", pa.int64()),
                        ("payload_bytes", pa.int64()), ("digest", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, data in zip(*(batch.column(i).to_pylist() for i in range(2))):
                rows = []
                for n, record in enumerate(read_arc(gunzip(data))):
                    head, payload = split_http(record.content)
                    page = http_field(head, "X-Page-Id")
                    rows.append((path, n, int(page) if page else None, len(payload), digest(payload)))
                if rows:
                    yield _rows(schema, rows)

    return arc.mapInArrow(run, "path string, n int, page_id long, payload_bytes long, digest string")


def convert(spark: SparkSession, arc_path: str, min_bytes: int = 0) -> str:
    """Write the ARC files of a folder, laid out by size class as ``write_arc`` does, as WARC files; returns their folder."""
    found = materialise(arc_payloads(_files(spark, arc_path)), "arc-payloads")
    firsts = materialise(found.where((F.col("payload_bytes") >= min_bytes) & F.col("page_id").isNotNull())
                         .groupBy(F.col("digest").alias("_digest"))
                         .agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("_n")).where("_n > 1"), "first-payloads")
    again = found.join(firsts, found["digest"] == firsts["_digest"]).where(F.col("page_id") != F.col("first"))
    # At most FILE_RECORDS rows per file.
    by_file = again.groupBy(F.col("path").alias("_path")).agg(F.collect_list(F.struct("n", "first")).alias("again"))
    schema = pa.schema([("record", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        info = warc_record("warcinfo", [("WARC-Record-ID", f"<{uuid.uuid5(uuid.NAMESPACE_URL, 'warcinfo').urn}>"),
                                        ("WARC-Date", "2024-01-01T00:00:00Z")], b"software: arc converter\r\n",
                           "application/warc-fields")
        for batch in batches:
            for data, pairs in zip(*(batch.column(i).to_pylist() for i in range(2))):
                refers = {p["n"]: p["first"] for p in pairs or ()}
                yield _rows(schema, [(info,), *((to_warc(r, refers.get(n)),) for n, r in enumerate(read_arc(gunzip(data))))])

    path = scratch_path(spark, "warc")
    for name, per_file in _classes().items():
        arc = _files(spark, f"{arc_path}/{name}")
        joined = arc.join(by_file, arc["path"] == by_file["_path"], "left").select("content", "again")
        _write(joined.mapInArrow(run, "record binary"), f"{path}/{name}", "\r\n\r\n", per_file)
    return path


def read_back(spark: SparkSession, warc_path: str) -> DataFrame:
    """One row per response or revisit: page_id, payload_bytes, payload_digest, record_type, refers_to."""
    schema = pa.schema([("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
                        ("record_type", pa.string()), ("refers_to", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for (data,) in zip(batch.column(0).to_pylist()):
                rows = []
                for fields, block in read_warc(gunzip(data)):
                    kind = fields["WARC-Type"]
                    if kind == "warcinfo":
                        continue
                    head, payload = split_http(block)
                    said, size = fields["WARC-Payload-Digest"].removeprefix("sha1:"), int(http_field(head, "Content-Length") or len(payload))
                    if kind == "response" and (digest(payload) != said or len(payload) != size):
                        raise ValueError(f"payload of {fields['WARC-Record-ID']} does not match its digest")
                    page, to = http_field(head, "X-Page-Id"), fields.get("WARC-Refers-To")
                    rows.append((int(page) if page else None, size, said, kind, page_of(to.strip("<>")) if to else None))
                if rows:
                    yield _rows(schema, rows)

    return _files(spark, warc_path).select("content").mapInArrow(
        run, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long")
