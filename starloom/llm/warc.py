"""WARC archives: a writer of gzip members, one per record, and a reader that splits archives at any byte.

Writing: every task writes its rows as one archive and reports it in a manifest; only reported archives are read, so files
of lost or repeated attempts do no harm. Records whose payloads are equal and at least MIN_REVISIT bytes long are stored
once, as the response with the largest page id; the others are revisits that name it.

Reading: archives are cut into byte ranges. A task looks for gzip magic from its range's first byte, accepts a candidate
only if it inflates to a WARC header, its checksum holds and it is followed by another magic or the end of the file, then
reads record after record. It owns the records that start inside its range and follows the last one past the range's end.

Archives live in a folder that all executors reach, through pyarrow.fs (file, HDFS, S3, GCS addresses).

Defined cases: a null payload is the empty one. Rows with equal payloads and the same largest page id are all responses.
A null page id is smaller than any other and is written as an empty number. A null URL is written as none; control
characters and spaces in URLs are percent-encoded. No rows, no archives, no records.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.llm.common import small_batches, table
from starloom.llm.registry import query
from starloom.session import fits_broadcast, materialize, shared_dir

MIN_REVISIT = 1000
SPLIT_BYTES = 4 << 20
WRITTEN_AT = "2026-01-01T00:00:00Z"
MAGIC = b"\x1f\x8b\x08"
_WINDOW = 1 << 18
_REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"


def _open(address: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(address.replace("s3a://", "s3://", 1))


def record_id(page) -> str:
    return f"<urn:starloom:page:{'' if page is None else page}>"


def member(page, url: str | None, payload: bytes, digest: str, refers_to, written_at: str = WRITTEN_AT) -> bytes:
    """One record as a gzip member; refers_to None for a response."""
    http = f"{_HTTP}Content-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: {record_id(page)}", f"WARC-Date: {written_at}"]
    if url is not None:
        head.append("WARC-Target-URI: " + "".join(c if " " < c != "\x7f" else "".join(f"%{b:02X}" for b in c.encode()) for c in url))
    if refers_to is not None:
        head += [f"WARC-Refers-To: {record_id(refers_to)}", f"WARC-Profile: {_REVISIT}"]
    head += [f"WARC-Payload-Digest: sha1:{digest}", f"WARC-Block-Digest: sha1:{hashlib.sha1(block).hexdigest()}",
             "Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}"]
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress("\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n") + packer.flush()


def planned_records(pages: DataFrame) -> DataFrame:
    """page_id, url, html, digest, refers_to of pages (page_id, url, html)."""
    text = F.coalesce("html", F.lit(""))
    rows = pages.select("page_id", "url", text.alias("html"), F.sha1(text.cast("binary")).alias("digest"), F.octet_length(text).cast("long").alias("size"))
    several = (rows.where(f"size >= {MIN_REVISIT}").groupBy("digest", "size").agg(F.max("page_id").alias("first"), F.count(F.lit(1)).alias("n"))
               .where("n > 1 and first is not null").drop("n"))
    several = materialize(several, "payloads")
    several = F.broadcast(several) if fits_broadcast(several) else several
    return rows.join(several, ["digest", "size"], "left").select("page_id", "url", "html", "digest", F.when(~F.col("first").eqNullSafe(F.col("page_id")), F.col("first")).alias("refers_to"))


def write_archives(records: DataFrame, folder: str) -> DataFrame:
    """Write records (page_id, url, html, digest, refers_to); the stored manifest: path, bytes, records."""
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context, size, count, out = TaskContext.get(), 0, 0, None
        system, base = _open(folder)
        path = f"part-{context.partitionId():06d}-{context.taskAttemptId()}.warc.gz"
        for batch in batches:
            for page, url, html, digest, refers_to in zip(*(c.to_pylist() for c in batch.columns)):
                if out is None:
                    system.create_dir(base, recursive=True)
                    out = system.open_output_stream(f"{base}/{path}", compression=None)
                data = member(page, url, html.encode(), digest, refers_to)
                out.write(data)
                size, count = size + len(data), count + 1
        if out is not None:
            out.close()
            yield pa.RecordBatch.from_pydict({"path": [f"{folder}/{path}"], "bytes": [size], "records": [count]})

    return materialize(records.select("page_id", "url", "html", "digest", "refers_to").mapInArrow(write, "path string, bytes long, records long"), "manifest")


class _Source:
    """A file read by position, with the last window kept."""

    def __init__(self, address: str):
        system, path = _open(address)
        self.file = system.open_input_file(path)
        self.size, self.at, self.data = self.file.size(), 0, b""

    def read(self, at: int, size: int = _WINDOW) -> bytes:
        if not (self.at <= at and at + size <= self.at + len(self.data)):
            self.file.seek(at)
            self.at, self.data = at, self.file.read(min(max(size, 2 * _WINDOW), self.size - at)) if at < self.size else b""
        return self.data[at - self.at:at - self.at + size]


def _inflate(source: _Source, at: int, all_of_it: bool) -> tuple[bytes, int] | None:
    """(content, end) of the gzip member at this byte; None if it is none or does not begin as a WARC record."""
    unpacker, parts, got, pos = zlib.decompressobj(31), [], 0, at
    try:
        while not unpacker.eof:
            data = source.read(pos)
            if not data:
                return None
            parts.append(unpacker.decompress(data))
            got, pos = got + len(parts[-1]), pos + len(data)
            if got >= 7 and not b"".join(parts[:3]).startswith(b"WARC/1."):
                return None
            if not all_of_it and got >= 7:
                break
    except zlib.error:
        return None
    content = b"".join(parts)
    return (content, pos - len(unpacker.unused_data)) if content.startswith(b"WARC/1.") else None


def owned_records(address: str, start: int, end: int) -> Iterator[tuple[int, dict[str, str], bytes]]:
    """(offset, headers, block) of the records whose first byte lies in [start, end)."""
    source, at, sure = _Source(address), start, start == 0
    while at < min(end, source.size):
        if source.read(at, 3) != MAGIC:
            window = source.read(at, _WINDOW)
            found = window.find(MAGIC, 1)
            at, sure = (at + found, False) if found > 0 else (at + max(1, len(window) - 2), False)
            continue
        whole = _inflate(source, at, True) if sure or _inflate(source, at, False) else None
        if whole is None or not (sure or whole[1] >= source.size or source.read(whole[1], 3) == MAGIC):
            at, sure = at + 1, False
            continue
        head, _, rest = whole[0].partition(b"\r\n\r\n")
        headers = dict(line.split(": ", 1) for line in head.decode("utf-8", "replace").split("\r\n")[1:] if ": " in line)
        yield at, headers, rest[:int(headers.get("Content-Length", len(rest)))]
        at, sure = whole[1], True


def read_archives(manifest: DataFrame, split_bytes: int = SPLIT_BYTES, payloads: bool = True) -> DataFrame:
    """One row per record of the archives in manifest (path, bytes), read range by range."""
    ranges = manifest.where("bytes > 0").select("path", "bytes", F.explode(F.sequence(F.lit(0).cast("long"), F.col("bytes") - 1, F.lit(split_bytes).cast("long"))).alias("start"))
    count = int(manifest.agg(F.coalesce(F.sum(F.ceil(F.col("bytes") / split_bytes)), F.lit(0))).first()[0])
    names = ["path", "at", "record_id", "record_type", "target_uri", "refers_to", "payload_digest", "stored_bytes", "computed_digest", "payload"]

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, start in zip(batch["path"], batch["start"]):
                rows, held = [], 0
                for at, headers, block in owned_records(path, int(start), int(start) + split_bytes):
                    payload = block.partition(b"\r\n\r\n")[2]
                    rows.append((path, at, headers.get("WARC-Record-ID"), headers.get("WARC-Type"), headers.get("WARC-Target-URI"), headers.get("WARC-Refers-To"),
                                 headers.get("WARC-Payload-Digest", "").removeprefix("sha1:"), len(payload), hashlib.sha1(payload).hexdigest(), payload if payloads else None))
                    held += len(payload)
                    if held > 4 << 20 or len(rows) >= 2000:
                        yield pd.DataFrame(rows, columns=names)
                        rows, held = [], 0
                yield pd.DataFrame(rows, columns=names)

    return (ranges.repartition(max(1, count), "path", "start").mapInPandas(scan, "path string, at long, record_id string, record_type string, target_uri string, refers_to string, "
                                                                          "payload_digest string, stored_bytes long, computed_digest string, payload binary"))


SQL = f"""
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages),
g AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest, payload_bytes) AS first FROM p)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN payload_bytes >= {MIN_REVISIT} AND first <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
CASE WHEN payload_bytes >= {MIN_REVISIT} AND first <> page_id THEN first END AS refers_to FROM g"""


@query("op2_warc", SQL)
def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write all pages, read all archives; a revisit's length is that of the response it names."""
    small_batches(spark)
    manifest = write_archives(planned_records(table(spark, sf_dir, "pages", "page_id", "url", "html")), f"{shared_dir(spark)}/starloom/warc-{uuid.uuid4().hex}")
    number = lambda c: F.when(F.regexp_extract(c, r":(-?\d+)>$", 1) != "", F.regexp_extract(c, r":(-?\d+)>$", 1).cast("long"))
    records = materialize(read_archives(manifest, payloads=False).select(number("record_id").alias("page_id"), "record_type", number("refers_to").alias("refers_to"),
                                                                         "stored_bytes", F.when(F.col("record_type") == "response", F.col("computed_digest")).otherwise(F.col("payload_digest")).alias("payload_digest")), "records")
    named = records.where("record_type = 'response'").groupBy(F.col("page_id").alias("refers_to"), "payload_digest").agg(F.max("stored_bytes").alias("named_bytes"))
    return (records.join(named, ["refers_to", "payload_digest"], "left")
            .select("page_id", F.coalesce("named_bytes", "stored_bytes").alias("payload_bytes"), "payload_digest", "record_type", "refers_to"))
