"""WARC archives: a writer with revisit records, and a splittable reader.

Every record is a gzip member of its own. The reader cuts archives into byte ranges; a task
scans its range for the gzip magic, takes a hit for a member if it decodes to a WARC header and
to its end, and owns the records that start inside the range, reading past its end to finish the last.

The writer makes sure that no member it writes has another one inside, which a range that
starts in between would take for a record: payloads may themselves be archives.

Archives are opened through ``pyarrow.fs`` by URI, so any store it knows can hold them.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Callable, Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docweave.llm.tables import bounded_batches, shared_folder, stored

MAGIC = b"\x1f\x8b\x08"
_VERSION = b"WARC/1."
#: Payloads of fewer bytes are always written out.
LEAST_REVISITED = 1000
#: An archive is closed when it has this many bytes.
ARCHIVE_BYTES = 256 << 20
#: Bytes of a range that one task scans.
RANGE_BYTES = 4 << 20
_STEP = 64 << 10
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_ID = re.compile(r"<urn:x-page:(-?\d*)>")

WRITTEN = "path string, bytes long, records long"
RECORDS = (
    "record_id string, record_type string, target_uri string, payload_digest string, "
    "refers_to string, payload_bytes long, payload binary, path string, offset long"
)


def _open(uri: str) -> tuple[fs.FileSystem, str]:
    if re.match(r"[a-z][a-z0-9+.-]*:", uri) and not uri.startswith("file:"):
        return fs.FileSystem.from_uri(uri)
    return fs.LocalFileSystem(), re.sub(r"^file:/+", "/", uri)


def _member(record: bytes) -> bytes:
    """The record as a gzip member in which no other WARC member begins."""
    for level in (6, 9, 1):
        pack = zlib.compressobj(level, zlib.DEFLATED, 31)
        data = pack.compress(record) + pack.flush()
        at = data.find(MAGIC, 1)
        while at >= 0 and _header(lambda here, at=at: data[at + here : at + here + _STEP]) is None:
            at = data.find(MAGIC, at + 1)
        if at < 0:
            return data
    # Incompressible data were stored as they are: without matches, coded letters never show raw bytes.
    pack = zlib.compressobj(9, zlib.DEFLATED, 31, 8, zlib.Z_HUFFMAN_ONLY)
    out = bytearray()
    for at in range(0, len(record), 2):
        out += pack.compress(record[at : at + 2])
        out += pack.flush(zlib.Z_SYNC_FLUSH)
    return bytes(out + pack.flush())


def _header(part: Callable[[int], bytes]) -> dict[str, str] | None:
    """The WARC header that a gzip member decodes to, however long it is, or None.

    ``part`` gives some of the member's bytes from a place in it on, none beyond the end of the data.
    """
    unpack, start, here, data = zlib.decompressobj(31), bytearray(), 0, b""
    try:
        while not unpack.eof:
            if not data:
                data = part(here)
                here += len(data)
                if not data:
                    return None
            seen = max(0, len(start) - 3)
            start += unpack.decompress(data, _STEP)
            data = unpack.unconsumed_tail
            if not start.startswith(_VERSION[: len(start)]):
                return None
            end = start.find(b"\r\n\r\n", seen)
            if end >= 0:
                return _fields(start[:end]) if start.startswith(_VERSION) else None
    except zlib.error:
        pass
    return None


def _fields(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8", "replace").split("\r\n")[1:]
    return {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines)}


def _record(page: int | None, url: str | None, payload: bytes, digest: str, keeper: int | None, date: str) -> bytes:
    revisit = keeper is not None
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    head = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: <urn:x-page:{'' if page is None else page}>",
        f"WARC-Date: {date}",
        f"WARC-Payload-Digest: sha1:{base64.b32encode(bytes.fromhex(digest)).decode()}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if url is not None:
        # Printable characters stay, others would break the header.
        head.append("WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f-\U0010ffff]", lambda m: quote(m.group()), url.replace("%", "%25")))
    if revisit:
        head += [f"WARC-Refers-To: <urn:x-page:{keeper}>", f"WARC-Profile: {_PROFILE}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def write_warc(pages: DataFrame, folder: str | None = None, date: str = "1970-01-01T00:00:00Z") -> DataFrame:
    """Writes a record per row of ``pages`` (``page_id``, ``url``, ``html``); returns ``path``, ``bytes``, ``records`` of each archive.

    The payload is the html in UTF-8, none for null. Of equal payloads of at least ``LEAST_REVISITED`` bytes
    those of the largest ``page_id`` are responses, the others revisit it; null ids count as
    smaller than any, and payloads that occur under null ids only are all responses. Rows
    that repeat an id are records of their own. A null url is left out. No rows make no archive.

    Files of lost or repeated tasks are never listed, so what the list names holds each record once.
    """
    spark = bounded_batches(pages.sparkSession)
    folder = folder or shared_folder(spark)
    payload = F.encode(F.coalesce("html", F.lit("")), "UTF-8")
    records = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", payload.alias("payload"))
    records = records.withColumn("digest", F.sha1("payload"))
    keepers = (
        records.filter(F.length("payload") >= LEAST_REVISITED).groupBy("digest")
        .agg(F.max("page_id").alias("keeper"), F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n")
    )
    records = records.join(keepers, "digest", "left").withColumn(
        "keeper", F.when(~F.col("page_id").eqNullSafe(F.col("keeper")), F.col("keeper"))
    ).select("page_id", "url", "payload", "digest", "keeper")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = _open(folder)
        out, path, size, count = None, "", 0, 0
        done = []

        def close():
            nonlocal out
            if out is not None:
                out.close()
                done.append((path, size, count))
                out = None

        for batch in batches:
            for k in range(batch.num_rows):
                row = [batch.column(c)[k].as_py() for c in range(5)]
                if out is None:
                    store.create_dir(root, recursive=True)
                    name = f"{uuid.uuid4().hex}.warc.gz"
                    path, size, count = f"{folder}/{name}", 0, 0
                    out = store.open_output_stream(f"{root}/{name}", compression=None)
                data = _member(_record(*row, date))
                out.write(data)
                size, count = size + len(data), count + 1
                if size >= ARCHIVE_BYTES:
                    close()
        close()
        yield pa.record_batch(
            [pa.array([d[0] for d in done], pa.string()), *(pa.array([d[i] for d in done], pa.int64()) for i in (1, 2))],
            names=["path", "bytes", "records"],
        )

    return stored(records.mapInArrow(write, WRITTEN))


class _Range:
    """Bytes of an archive from a start on, read as they are asked for."""

    def __init__(self, file, start: int, size: int):
        self.file, self.start, self.size, self.data = file, start, size, bytearray()

    def upto(self, end: int) -> None:
        end = min(end, self.size)
        have = self.start + len(self.data)
        if end > have:
            self.file.seek(have)
            self.data += self.file.read(end - have)

    def part(self, at: int, size: int) -> bytes:
        self.upto(at + size)
        return bytes(self.data[at - self.start : at - self.start + size])


def _whole(window: _Range, at: int) -> tuple[bytes, int] | None:
    """The content of the member at this offset and the offset after it, or None if there is no whole member."""
    unpack, out, here = zlib.decompressobj(31), [], at
    try:
        while not unpack.eof:
            if here >= window.size:
                return None
            window.upto(here + 4 * _STEP)
            part = bytes(window.data[here - window.start : here - window.start + 4 * _STEP])
            out.append(unpack.decompress(part))
            here += len(part)
    except zlib.error:
        return None
    return b"".join(out), here - len(unpack.unused_data)


def _records(file, path: str, start: int, end: int, size: int) -> Iterator[tuple]:
    """The records that start from ``start`` to before ``end``."""
    window = _Range(file, start, size)
    window.upto(end + len(MAGIC) - 1)
    at = start
    while True:
        found = window.data.find(MAGIC, at - start, end - start + len(MAGIC) - 1)
        if found < 0:
            return
        at = start + found
        fields = _header(lambda here, at=at: window.part(at + here, _STEP))
        whole = _whole(window, at) if fields is not None else None
        if whole is None:
            at += 1
            continue
        content, after = whole
        head, _, block = content.partition(b"\r\n\r\n")
        block = block[: int(fields.get("content-length", "0"))]
        http, _, payload = block.partition(b"\r\n\r\n") if block.startswith(b"HTTP/") else (b"", b"", block)
        kind = fields.get("warc-type", "")
        digest = fields.get("warc-payload-digest", "")
        length = len(payload)
        if kind == "revisit":
            length = int(_fields(http).get("content-length", "0"))
            digest = base64.b32decode(digest.removeprefix("sha1:")).hex() if digest.startswith("sha1:") else None
            payload = None
        else:
            digest = hashlib.sha1(payload).hexdigest()
        uri = fields.get("warc-target-uri")
        yield (fields.get("warc-record-id"), kind, None if uri is None else unquote(uri), digest, fields.get("warc-refers-to"), length, payload, path, at)
        at = after


def read_warc(spark: SparkSession, archives: DataFrame, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """The records of the archives in ``path``, ``bytes``, as ``RECORDS`` has them.

    ``payload_bytes`` and ``payload_digest`` (SHA-1 in lower-case hex) are of the full payload; a response's are
    taken from what was read, a revisit's, whose payload is null, from its header. Bytes
    that belong to no whole member are passed over.
    """
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranges = archives.filter("bytes > 0").select(
        "path", "bytes", F.explode(F.sequence(F.lit(0).cast("long"), F.col("bytes") - 1, F.lit(range_bytes).cast("long"))).alias("start")
    ).repartition(tasks)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([
            ("record_id", pa.string()), ("record_type", pa.string()), ("target_uri", pa.string()), ("payload_digest", pa.string()),
            ("refers_to", pa.string()), ("payload_bytes", pa.int64()), ("payload", pa.binary()), ("path", pa.string()), ("offset", pa.int64()),
        ])
        held, weight = [], 0
        for batch in batches:
            for row in batch.to_pylist():
                store, name = _open(row["path"])
                with store.open_input_file(name) as file:
                    end = min(row["start"] + range_bytes, row["bytes"])
                    for record in _records(file, row["path"], row["start"], end, row["bytes"]):
                        held.append(record)
                        weight += record[5] + 500
                        if weight > 8 << 20:
                            yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), schema, strict=True)], schema=schema)
                            held, weight = [], 0
        if held:
            yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), schema, strict=True)], schema=schema)

    return ranges.mapInArrow(read, RECORDS)


def page_number(column: str):
    """The page id in a record id of ``write_warc``; null if it has none."""
    return F.regexp_extract(column, _ID.pattern, 1).try_cast("long")


SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS payload FROM pages),
d AS (SELECT page_id, strlen(payload)::BIGINT AS payload_bytes, sha1(payload) AS payload_digest FROM p),
k AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS keeper FROM d)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 1000 AND page_id <> keeper THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 1000 AND page_id <> keeper THEN keeper END AS refers_to
FROM k
"""
