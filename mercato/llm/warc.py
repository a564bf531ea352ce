"""WARC archives: a writer through Spark's own file writer, and a salvage reader.

Writer.  Every page becomes one record, compressed as a gzip member of its own.  Pages with
equal payloads are found by SHA-1: the one with the smallest id is a response, the others
are revisits of it.  Archives are written by Spark's text writer, so they go to any store
that Spark writes, through its commit protocol: a member's bytes are the line, and the line
separator is the zero byte that every member ends with (the top byte of its length field; a
record of 16 MiB or more is followed by an empty member, which also ends so).

Reader.  An archive is read record by record: a gzip member (or, in a plain archive, a
version line) must parse, its block must have the stated length and its payload the stated
digest.  Where a check fails the reader searches for the next place that begins a valid
record, goes on from there, and logs the bytes between as a quarantined gap with its reason.
Gaps lose only the records in them.

Defined results: null html is an empty payload; a null url has no target; a null page id is
larger than all ids and its record has no page header; of repeated rows with one id and
payload one is the response; control characters in a url are percent-encoded; an empty
table writes no records and reads as none.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir, ship_package
from .tables import written

VERSION = b"WARC/1.1"
#: Payloads of at least so many bytes are revisited.
MIN_BYTES = 0
DATE = "2024-01-01T00:00:00Z"
#: Pages in an archive, at most.
PAGES = 2000
_GZIP = b"\x1f\x8b\x08"


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload, usedforsecurity=False).digest()).decode()


def record_id(page_id) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}')}>"


def _clean(url: str) -> str:
    return "".join(c if c > " " and c != "\x7f" else "".join(f"%{b:02X}" for b in c.encode()) for c in url)


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool) -> bytes:
    """A record's bytes, uncompressed."""
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n").encode()
    block = http if revisit else http + payload
    head = [("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", record_id(page_id)), ("WARC-Date", DATE)]
    if url is not None:
        head.append(("WARC-Target-URI", _clean(url)))
    head += [("WARC-Payload-Digest", "sha1:" + digest(payload)), ("Content-Type", "application/http; msgtype=response")]
    if revisit:
        head.append(("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"))
        if refers_to is not None:
            head += [("WARC-Refers-To", record_id(refers_to)), ("X-Refers-To-Page", str(refers_to))]
    if page_id is not None:
        head.append(("X-Page", str(page_id)))
    head += [("X-Payload-Length", str(len(payload))), ("Content-Length", str(len(block)))]
    lines = "".join(f"{k}: {v}\r\n" for k, v in head)
    return VERSION + b"\r\n" + lines.encode() + b"\r\n" + block + b"\r\n\r\n"


def member(raw: bytes) -> bytes:
    """One gzip member that ends with a zero byte (see the module)."""
    squeeze = lambda x: (c := zlib.compressobj(6, zlib.DEFLATED, 31)).compress(x) + c.flush()
    out = squeeze(raw)
    return out if out[-1] == 0 else out + squeeze(b"")


def _write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, len(batch), 64):
            rows = batch.slice(at, 64).to_pylist()
            lines = [member(record(r["page_id"], r["url"], (r["html"] or "").encode(), r["refers_to"], r["revisit"]))[:-1] for r in rows]
            yield pa.RecordBatch.from_arrays([pa.array(lines, pa.binary())], ["line"])


def write_archives(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
                   min_bytes: int = MIN_BYTES) -> None:
    """Write one record per row of ``pages`` below ``path`` (part files are ``.txt`` archives)."""
    spark = pages.sparkSession
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"),
                        F.col(html_col).cast("string").alias("html"))
    payload = F.coalesce(F.encode("html", "UTF-8"), F.lit(b""))
    order = F.struct(F.col("page_id").isNull().alias("n"), F.coalesce("page_id", F.lit(0)).alias("i"), F.col("u"))
    keyed = written(rows.select("*", F.unhex(F.sha1(payload)).alias("key"), F.octet_length(payload).alias("size"),
                                F.monotonically_increasing_id().alias("u")), "warc-pages")
    known = keyed.select("page_id", "key", "size", "u")
    first = (known.where(F.col("size") >= min_bytes).groupBy("key").agg(F.min(order).alias("f"), F.count(F.lit(1)).alias("c"))
             .where("c > 1").select("key", F.col("f.u").alias("first"), F.when(~F.col("f.n"), F.col("f.i")).alias("refers_to")).checkpoint())
    again = (known.where(F.col("size") >= min_bytes).join(first, "key").where("u <> first").select("u", "refers_to").checkpoint())
    marked = (keyed.select("page_id", "url", "html", "u").join(again.withColumn("revisit", F.lit(True)), "u", "left")
              .select("page_id", "url", "html", "refers_to", F.coalesce("revisit", F.lit(False)).alias("revisit")))
    (marked.mapInArrow(_write, "line binary").select(F.col("line").cast("string"))
     .write.option("lineSep", "\0").option("maxRecordsPerFile", PAGES).text(path))


def _inflate(data: memoryview, at: int) -> tuple[bytes, int] | None:
    """The member at ``at`` and where it ends."""
    reader = zlib.decompressobj(31)
    try:
        out = reader.decompress(data[at:])
    except zlib.error:
        return None
    return (out, len(data) - len(reader.unused_data)) if reader.eof else None


def parse(raw: bytes, at: int = 0) -> tuple[dict, int] | str:
    """The record at ``at`` of plain WARC bytes with its end, or why there is none."""
    if raw[at: at + 5] != b"WARC/":
        return "no version line"
    split = raw.find(b"\r\n\r\n", at)
    if split < 0:
        return "header without an end"
    head = {}
    for line in raw[at:split].split(b"\r\n")[1:]:
        name, colon, value = line.partition(b":")
        if not colon:
            return "broken header line"
        key = name.strip().lower().decode("latin-1")
        if key in head:  # another record's header behind a cut one
            return "repeated header line"
        head[key] = value.strip().decode("utf-8", "replace")
    if not head.get("content-length", "").isdigit():
        return "no length"
    start = split + 4
    end = start + int(head["content-length"])
    if raw[end: end + 4] != b"\r\n\r\n":
        return "block and length differ"
    block = raw[start:end]
    kind = head.get("warc-type")
    payload = block.partition(b"\r\n\r\n")[2] if "http" in head.get("content-type", "") else block
    stated = head.get("warc-payload-digest", "").removeprefix("sha1:")
    if kind == "response" and stated and digest(payload) != stated:
        return "payload and digest differ"
    number = lambda key: int(head[key]) if head.get(key, "").lstrip("-").isdigit() else None
    return {"page_id": number("x-page"), "url": head.get("warc-target-uri"), "record_type": kind,
            "payload_bytes": len(payload) if kind == "response" else number("x-payload-length"),
            "payload_digest": stated or digest(payload), "refers_to": number("x-refers-to-page"),
            "payload": payload if kind == "response" else None}, end + 4


def salvage(data: bytes) -> Iterator[tuple[int, int, dict | str]]:
    """(from, to, record or the reason of a gap) in the order of the bytes; the spans cover
    the archive without overlap."""
    view, at, bad, why = memoryview(data), 0, None, ""
    while at < len(data):
        record, end = None, at
        if data[at: at + 3] == _GZIP:
            got = _inflate(view, at)
            if got is None:
                reason = "broken member"
            elif not got[0]:
                record, end = {}, got[1]  # an empty member is padding
            else:
                read = parse(got[0])
                if isinstance(read, str):
                    reason = read
                elif read[1] != len(got[0]):
                    reason = "more in the member than its record"
                else:
                    record, end = read[0], got[1]
        else:
            read = parse(data, at)
            if isinstance(read, str):
                reason = read
            else:
                record, end = read
        if record is None:
            if bad is None:
                bad, why = at, reason
            found = [x for x in (data.find(_GZIP, at + 1), data.find(b"WARC/", at + 1)) if x >= 0]
            at = min(found, default=len(data))
            continue
        if bad is not None:
            yield bad, at, why
            bad = None
        if record:
            yield at, end, record
        at = end
    if bad is not None:
        yield bad, len(data), why


_FIELDS = ("page_id", "url", "record_type", "payload_bytes", "payload_digest", "refers_to", "payload")
SCHEMA = ("archive string, start long, end long, gap string, page_id long, url string, record_type string, payload_bytes long, "
          "payload_digest string, refers_to long, payload binary")


def _read(batches: Iterator[pa.RecordBatch], payloads: bool) -> Iterator[pa.RecordBatch]:
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.binary()]
    names = [x.split()[0] for x in SCHEMA.split(", ")]

    def made(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], kind) for c, kind in enumerate(kinds)], names)

    for batch in batches:
        for row in range(len(batch)):
            path, data, rows = batch.column(0)[row].as_py(), batch.column(1)[row].as_py(), []
            for start, end, found in salvage(data):
                if isinstance(found, str):
                    rows.append((path, start, end, found, *[None] * len(_FIELDS)))
                else:
                    rows.append((path, start, end, None, *(found[f] if payloads or f != "payload" else None for f in _FIELDS)))
                if len(rows) >= 256:
                    yield made(rows)
                    rows = []
            if rows:
                yield made(rows)


def read_archives(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """Records and gaps (``gap`` is their reason, null for records) of all archives below
    ``path``.  An archive is read by one task: keep archives to some hundred MB, as the writer does."""
    ship_package(spark)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.select("path", "content").mapInArrow(functools.partial(_read, payloads=payloads), SCHEMA)
