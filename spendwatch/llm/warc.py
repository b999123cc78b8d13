"""WARC archives: write one gzip member per record, read them back sequentially.

Writer: equal payloads (same SHA-1 and length) of at least ``min_dedup_bytes`` share
one response, that of the smallest page_id; the others are revisit records that refer to it.
Groups of any size are found by salted minima. A task packs whole members into
archives of about ``archive_bytes``, and Spark's text writer commits each as one gzip file
in the shared folder, so a lost executor's archives are written again.

Reader: an archive is one binary row; each member is inflated in steps of
``STEP`` bytes, headers are parsed to the blank line, the block is framed by Content-Length, and block
and payload digests are verified. A broken member raises ``WarcError``.

Rows: a NULL html is an empty payload; a NULL url has no target URI; a NULL page_id
is never referred to if its group has an id (it revisits the least one) and is a response otherwise;
rows that repeat the least page_id of their group are all responses. No pages: no archives, no rows.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spendwatch.llm.common import salted_min, shared_dir, utf8_bytes

#: Compressed bytes handed to the inflater at a time, and the most it may give back at a time.
STEP = 1 << 16
ARCHIVE_BYTES = 32 << 20
_NAMESPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")
_DATE = "2024-01-01T00:00:00Z"
_REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: An empty gzip member: what the text writer puts at an archive's end as its line separator.
_EMPTY_MEMBER = bytes.fromhex("1f8b080000000000000303000000000000000000")


class WarcError(ValueError):
    """A record whose framing or digest is wrong."""


def digest(data: bytes) -> str:
    """Upper-case base32 SHA-1."""
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_id(page_id: int | None) -> str:
    return f"<urn:uuid:{uuid.uuid5(_NAMESPACE, f'page:{page_id}')}>"


def _line(text: str) -> str:
    """A header value on one line."""
    return "".join(c if c >= " " and c != "\x7f" else f"%{ord(c):02X}" for c in text)


def build_record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """One WARC record; a revisit keeps the HTTP head and leaves out the payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: {record_id(page_id)}"]
    head += [f"WARC-Date: {_DATE}", "Content-Type: application/http; msgtype=response"]
    if page_id is not None:
        head.append(f"WARC-Page-ID: {page_id}")
    if url is not None:
        head.append(f"WARC-Target-URI: {_line(url)}")
    if refers_to is not None:
        head += [f"WARC-Refers-To: {record_id(refers_to)}", f"WARC-Refers-To-Page-ID: {refers_to}", f"WARC-Profile: {_REVISIT}"]
    head += [f"WARC-Payload-Digest: sha1:{digest(payload)}", f"WARC-Block-Digest: sha1:{digest(block)}"]
    head.append(f"Content-Length: {len(block)}")
    return "\r\n".join(head).encode("utf-8", "surrogatepass") + b"\r\n\r\n" + block + b"\r\n\r\n"


def member(record: bytes) -> bytes:
    """The record as a gzip member of its own."""
    z = zlib.compressobj(6, zlib.DEFLATED, 31)
    return z.compress(record) + z.flush()


def members(archive: bytes) -> Iterator[bytes]:
    """The inflated members in order; at most one member is held."""
    view, at = memoryview(archive), 0
    while at < len(view):
        z, out = zlib.decompressobj(31), []
        while not z.eof:
            step = z.unconsumed_tail or view[at : at + STEP]
            if not z.unconsumed_tail:
                at += len(step)
            if not len(step):
                raise WarcError("the archive ends inside a gzip member")
            out.append(z.decompress(step, STEP))
        at -= len(z.unused_data)
        yield b"".join(out)


def parse_record(data: bytes) -> dict:
    """Headers, block and verified digests of one record."""
    end = data.find(b"\r\n\r\n")
    if end < 0 or not data.startswith(b"WARC/1."):
        raise WarcError("no WARC header")
    head = {}
    for line in data[:end].decode("utf-8", "surrogatepass").split("\r\n")[1:]:
        name, _, value = line.partition(":")
        head[name.lower()] = value.strip()
    length = int(head["content-length"])
    block = data[end + 4 : end + 4 + length]
    if len(block) != length or data[end + 4 + length :] != b"\r\n\r\n":
        raise WarcError(f"{head.get('warc-record-id')}: Content-Length does not frame the block")
    if head.get("warc-block-digest", f"sha1:{digest(block)}") != f"sha1:{digest(block)}":
        raise WarcError(f"{head.get('warc-record-id')}: wrong block digest")
    http, _, payload = block.partition(b"\r\n\r\n")
    kind, named = head["warc-type"], head["warc-payload-digest"].removeprefix("sha1:")
    stated = int(next(x.split(b":")[1] for x in http.lower().split(b"\r\n") if x.startswith(b"content-length:")))
    if kind == "response" and (len(payload) != stated or digest(payload) != named):
        raise WarcError(f"{head.get('warc-record-id')}: wrong payload digest")
    return head | {"payload": payload if kind == "response" else None, "payload_bytes": stated, "payload_digest": named, "kind": kind}


_READ = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary"


def write_warc(pages: DataFrame, min_dedup_bytes: int = 0, archive_bytes: int = ARCHIVE_BYTES) -> str:
    """Writes a record for each page; returns the archives' folder."""
    spark = pages.sparkSession
    payload = F.coalesce(F.col("html"), F.lit(""))
    keyed = pages.select("page_id", "url", "html").select(
        "*",
        F.sha1(payload.cast("binary")).alias("_sha1"),
        F.octet_length(payload).alias("_bytes"),
    )
    narrow = keyed.select("page_id", "_sha1", "_bytes").where(F.col("_bytes") >= min_dedup_bytes)
    # only ids that are not their group's least need a join with the payloads
    revisits = (
        salted_min(narrow, ["_sha1", "_bytes"], "page_id", "_first")
        .where("not page_id <=> _first")
        .select(F.col("page_id").alias("_id"), F.col("_sha1").alias("_of"), "_first")
        .distinct()
    )
    rows = keyed.join(revisits, F.col("page_id").eqNullSafe(F.col("_id")) & (F.col("_sha1") == F.col("_of")), "left")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            ids, urls, htmls, firsts = (batch.column(i) for i in range(4))
            for i, u, h, f in zip(ids, urls, htmls, firsts):
                held.append(member(build_record(i.as_py(), u.as_py(), utf8_bytes(h.as_py()), f.as_py())))
                size += len(held[-1])
                if size >= archive_bytes:
                    yield pa.RecordBatch.from_arrays([pa.array([b"".join(held)], pa.binary())], ["archive"])
                    held, size = [], 0
        if held:
            yield pa.RecordBatch.from_arrays([pa.array([b"".join(held)], pa.binary())], ["archive"])

    archives = rows.select("page_id", "url", "html", "_first").mapInArrow(pack, "archive binary")
    path = shared_dir(spark, "warc")
    (
        archives.select(F.col("archive").cast("string").alias("value"))
        .write.option("maxRecordsPerFile", 1)
        .option("encoding", "ISO-8859-1")
        .option("lineSep", _EMPTY_MEMBER.decode("latin-1"))
        .text(path)
    )
    return path


def read_warc(spark: SparkSession, path: str, with_payload: bool = False) -> DataFrame:
    """A row for each response or revisit record of the archives under ``path``."""
    archives = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("content")

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload"]
        kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()]

        def batch(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kinds[k]) for k in range(7)], names)

        for got in batches:
            for content in got.column(0):
                rows, size = [], 0
                for data in members(content.as_buffer()):
                    if not data:  # an archive's closing empty member
                        continue
                    r = parse_record(data)
                    ids = [int(r[k]) if k in r else None for k in ("warc-page-id", "warc-refers-to-page-id")]
                    url, payload = r.get("warc-target-uri"), r["payload"] if with_payload else None
                    rows.append((ids[0], url, r["payload_bytes"], r["payload_digest"], r["kind"], ids[1], payload))
                    size += 200 + len(payload or b"")
                    if size > 4 << 20:
                        yield batch(rows)
                        rows, size = [], 0
                if rows:
                    yield batch(rows)

    return archives.mapInArrow(scan, _READ)


def warc_round_trip(pages: DataFrame, min_dedup_bytes: int = 0) -> DataFrame:
    """Writes the pages and returns what the archives say of each."""
    path = write_warc(pages, min_dedup_bytes)
    return read_warc(pages.sparkSession, path).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def warc_sql() -> str:
    """DuckDB SQL of ``warc_round_trip``; base32 by groups of five hex digits."""
    alphabet = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
    digits = " || ".join(
        f"substr('{alphabet}', ((('0x' || substr(h, {5 * g + 1}, 5))::INT >> {5 * (3 - d)}) & 31) + 1, 1)" for g in range(8) for d in range(4)
    )
    return f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
d AS (SELECT page_id, html, sha1(html) AS h, min(page_id) OVER (PARTITION BY html) AS first FROM p)
SELECT page_id, strlen(html)::BIGINT AS payload_bytes, {digits} AS payload_digest,
  CASE WHEN page_id IS NOT DISTINCT FROM first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id IS DISTINCT FROM first THEN first END AS refers_to
FROM d"""
