"""WARC archives: a writer with identical-payload revisits, and a splittable reader.

Writer: one gzip member per record; each task streams its rows into archive files of its own under new names
and returns their paths and lengths. Only files named in the written manifest count, so a lost or repeated task
attempt leaves at most files that nobody reads.

Reader: the manifest is cut into byte ranges. A task looks for the gzip magic in its range, takes a candidate
as a record if it decodes and starts with a WARC version line, and owns the records whose first byte lies inside
its range (they may end in the next one). The decoder's end of member is the next record's start, so bytes
inside a known record are never searched.

Defined cases: a null payload is empty; a null url gives no target header; rows that repeat id and payload are
all written as responses if theirs is the smallest id of that payload, else all as revisits; a null id is
never the response of a group unless the group has no other; an empty table gives an empty manifest.
"""

from __future__ import annotations

import base64
import hashlib
import os
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cabwh.llm.common import first_per_key, lookup_salted, plain, salt_of, shared_dir, table, written

MAGIC = b"\x1f\x8b\x08"
VERSION = b"WARC/1.1\r\n"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_CHUNK = 1 << 18
MANIFEST_SCHEMA = "path string, bytes long, records long"
RECORD_SCHEMA = ("id long, record_type string, url string, payload_bytes long, payload_digest string, "
                 "refers_to long, payload binary")


def digest32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _open(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path) if "://" in path else fs.FileSystem.from_uri(
        "file://" + path.removeprefix("file:"))


def _header_safe(url: str) -> str:
    """Control characters, blanks and non-ASCII percent-encoded: a header is one ASCII line."""
    return "".join(chr(b) if 0x20 < b < 0x7F else f"%{b:02X}" for b in url.encode())


def encode_record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool) -> bytes:
    """One gzip member: WARC header, HTTP header and, for a response, the payload."""
    name = lambda i: "<urn:page:" + ("" if i is None else str(i)) + ">"
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    body = http if revisit else http + payload
    head = [f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {name(page_id)}",
            "WARC-Date: 2024-01-01T00:00:00Z", "Content-Type: application/http; msgtype=response",
            f"WARC-Payload-Digest: sha1:{digest32(payload)}", f"Content-Length: {len(body)}"]
    if url is not None:
        head.append(f"WARC-Target-URI: {_header_safe(url)}")
    if revisit:
        head += [f"WARC-Profile: {REVISIT_PROFILE}", f"WARC-Refers-To: {name(refers_to)}"]
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(VERSION + "\r\n".join(head).encode() + b"\r\n\r\n" + body + b"\r\n\r\n") + packer.flush()


def write_archives(pages: DataFrame, out_dir: str, id_col: str = "page_id", url_col: str = "url",
                   html_col: str = "html", min_revisit_bytes: int = 0, file_bytes: int = 256 << 20) -> DataFrame:
    """Write every row as a WARC record below ``out_dir``; returns the manifest (path, bytes, records).

    Of rows with equal payloads of at least ``min_revisit_bytes`` bytes, the one with the smallest id is the
    response and the others are revisits of it.
    """
    rows = plain(pages, id=id_col, url=url_col, html=html_col).withColumn(
        "html", F.coalesce(F.col("html"), F.lit("")).cast("binary"))
    prints = written(rows.select("id", F.sha1("html").alias("sha"), F.octet_length("html").alias("size"))
                     .withColumn("salt", salt_of("id")), "payload-digests")
    first = first_per_key(prints.filter(F.col("size") >= min_revisit_bytes), "sha", "id").filter("n > 1")
    again = (lookup_salted(prints, first, "sha").filter(~F.col("id").eqNullSafe(F.col("first_id")))
             .select(F.col("id").alias("r_id"), F.col("sha").alias("r_sha"), F.col("first_id").alias("refers_to"),
                     F.lit(True).alias("revisit")).distinct())
    # by (id, digest), which does not repeat: the payloads themselves are never dealt out by a hot digest
    planned = rows.withColumn("sha", F.sha1("html")).join(
        again, F.col("id").eqNullSafe(F.col("r_id")) & (F.col("sha") == F.col("r_sha")), "left")
    if not out_dir.startswith("file:") and "://" not in out_dir:
        out_dir = f"file://{os.path.abspath(out_dir)}"

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, folder = _open(out_dir)
        store.create_dir(folder, recursive=True)
        out, path, size, n = None, "", 0, 0

        def closed() -> pa.RecordBatch:
            out.close()
            return pa.RecordBatch.from_pydict({"path": [path], "bytes": [size], "records": [n]})

        for batch in batches:
            for row in batch.to_pylist():
                if out is None:
                    name = f"part-{uuid.uuid4().hex}.warc.gz"
                    path, size, n = f"{out_dir}/{name}", 0, 0
                    out = store.open_output_stream(f"{folder}/{name}", compression=None)
                member = encode_record(row["id"], row["url"], row["html"], row["refers_to"], bool(row["revisit"]))
                out.write(member)
                size, n = size + len(member), n + 1
                if size >= file_bytes:
                    yield closed()
                    out = None
        if out is not None:
            yield closed()

    return written(planned.select("id", "url", "html", "refers_to", "revisit").mapInArrow(write, MANIFEST_SCHEMA),
                   "archive-manifest")


def decode_member(f, at: int) -> tuple[bytes, int] | None:
    """The content and end of the gzip member at byte ``at``, or None if no WARC record starts there."""
    f.seek(at)
    unpacker, parts, checked, read = zlib.decompressobj(31), [], False, 0
    while not unpacker.eof:
        chunk = f.read(_CHUNK if checked else 4096)
        if not chunk:
            if checked:
                raise ValueError(f"the record at byte {at} is cut off")
            return None
        read += len(chunk)
        try:
            parts.append(unpacker.decompress(chunk))
        except zlib.error:
            if checked:
                raise
            return None
        if not checked:
            start = b"".join(parts)[:5]
            if not b"WARC/".startswith(start):
                return None
            checked = len(start) == 5
    return (b"".join(parts), at + read - len(unpacker.unused_data)) if checked else None


def members(f, start: int, end: int) -> Iterator[bytes]:
    """The records of an archive whose first byte lies in [start, end)."""
    at = start
    while at < end:
        f.seek(at)
        window = f.read(min(_CHUNK, end - at + len(MAGIC) - 1))
        hit = window.find(MAGIC)
        if hit < 0:
            if len(window) < len(MAGIC):
                return
            at += len(window) - len(MAGIC) + 1
            continue
        found = decode_member(f, at + hit) if at + hit < end else None
        if found:
            yield found[0]
        at = found[1] if found else at + hit + 1


def parse_record(raw: bytes) -> dict:
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    number = lambda k: int(v) if (v := fields.get(k, "")[len("<urn:page:"):-1]) else None
    http, _, payload = rest[: int(fields["Content-Length"])].partition(b"\r\n\r\n")
    length = int(dict(line.split(": ", 1) for line in http.decode().split("\r\n")[1:])["Content-Length"])
    kind, digest = fields["WARC-Type"], fields["WARC-Payload-Digest"].removeprefix("sha1:")
    if kind == "response" and (len(payload) != length or digest32(payload) != digest):
        raise ValueError(f"payload of {fields['WARC-Record-ID']} does not match its digest")
    return {"id": number("WARC-Record-ID"), "record_type": kind, "url": fields.get("WARC-Target-URI"),
            "payload_bytes": length, "payload_digest": digest, "refers_to": number("WARC-Refers-To"),
            "payload": payload if kind == "response" else None}


def read_archives(manifest: DataFrame, split_bytes: int = 8 << 20) -> DataFrame:
    """Every record of the archives in ``manifest`` (path, bytes), read in ranges of ``split_bytes``."""
    spark = manifest.sparkSession
    ranges = manifest.filter("bytes > 0").select("path", "bytes", F.explode(F.expr(
        f"sequence(0L, bytes - 1, {int(split_bytes)}L)")).alias("start"))
    tasks = manifest.agg(F.sum(F.ceil(F.col("bytes") / split_bytes))).first()[0] or 1
    schema = pa.schema([("id", pa.int64()), ("record_type", pa.string()), ("url", pa.string()),
                        ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("refers_to", pa.int64()),
                        ("payload", pa.binary())])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                store, path = _open(r["path"])
                rows, size = [], 0
                with store.open_input_file(path) as f:
                    for raw in members(f, r["start"], min(r["start"] + split_bytes, r["bytes"])):
                        rows.append(parse_record(raw))
                        size += len(raw)
                        if size > 8 << 20:
                            yield pa.RecordBatch.from_pylist(rows, schema)
                            rows, size = [], 0
                yield pa.RecordBatch.from_pylist(rows, schema)

    # a range is a tiny row that stands for much work: one task each, not coalesced by size
    return ranges.repartition(int(tasks), "path", "start").mapInArrow(read, RECORD_SCHEMA)


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write all pages as WARC, read the archives back, and report each record."""
    manifest = write_archives(table(spark, sf_dir, "pages"), shared_dir(spark, "warc"))
    return read_archives(manifest).select(F.col("id").alias("page_id"), "payload_bytes", "payload_digest",
                                          "record_type", "refers_to")


SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
g AS (SELECT page_id, body, sha1(body) AS h, min(page_id) OVER (PARTITION BY body) AS first_id FROM p),
d AS (SELECT *, [('0x' || substr(h, CAST(5 * i + 1 AS BIGINT), 5))::BIGINT FOR i IN range(8)] AS q FROM g)
SELECT page_id, CAST(strlen(body) AS BIGINT) AS payload_bytes,
       list_aggregate(flatten([[substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST((v // m) % 32 + 1 AS BIGINT), 1)
         FOR m IN [32768, 1024, 32, 1]] FOR v IN q]), 'string_agg', '') AS payload_digest,
       CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = first_id THEN NULL ELSE first_id END AS refers_to
FROM d
"""
