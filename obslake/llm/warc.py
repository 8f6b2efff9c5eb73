"""Archives of web pages with revisit records in place of repeated payloads.

Only headers are compared: the digests of all payloads are counted, and a repeated payload's
largest page id becomes its response. Payloads meet that small table without being gathered,
are written once each, and every other capture becomes a revisit that names the response.
Archives are made in the tasks, cut at ``ARCHIVE_BYTES`` or one record, and committed by Spark's
writer, compressed. They are read back file by file, each of a bounded size, by the lengths in
their headers; revisits are then resolved by a join with the responses.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator
from datetime import datetime, timezone

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from obslake.llm.scratch import stored

LEAST_BYTES = 1000
ARCHIVE_BYTES = 16 * 1024 * 1024

# Fixed values of the WARC 1.1 format.
VERSION = "WARC/1.1"
BETWEEN = "\r\n\r\n"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def _base32(digest: str) -> str:
    return base64.b32encode(bytes.fromhex(digest)).decode()


def record_id(page: int | None) -> str:
    return f"<urn:page:{'null' if page is None else page}>"


def _page_of(urn: str) -> int | None:
    name = urn.strip("<>").rpartition(":")[2]
    return None if name == "null" else int(name)


def _target(url: str | None) -> list[str]:
    """The target line; characters a header cannot hold are percent-encoded."""
    if not url:
        return []
    return ["WARC-Target-URI: " + "".join(c if 32 < ord(c) != 127 else "".join(f"%{b:02X}" for b in c.encode()) for c in url)]


def record(page: int | None, url: str | None, html: str, digest: str, response: int | None, date: str) -> str:
    """One record with fresh headers; ``response`` is the page a revisit refers to."""
    lines = [VERSION, f"WARC-Record-ID: {record_id(page)}", f"WARC-Date: {date}", *_target(url)]
    lines.append(f"WARC-Payload-Digest: sha1:{_base32(digest)}")
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(html.encode())}{BETWEEN}"
    if response is None:
        lines.append("WARC-Type: response")
        block = http + html
    else:
        lines += ["WARC-Type: revisit", f"WARC-Profile: {REVISIT_PROFILE}", f"WARC-Refers-To: {record_id(response)}"]
        block = http
    lines += ["Content-Type: application/http;msgtype=response", f"Content-Length: {len(block.encode())}"]
    return "\r\n".join(lines) + BETWEEN + block


def with_revisits(pages: DataFrame) -> DataFrame:
    """page_id, url, html, digest and refers_to (null for responses), one row per row of ``pages``."""
    html = F.coalesce(F.col("html"), F.lit(""))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", html.alias("html"), F.sha1(html).alias("digest"))
    repeated = (
        rows.where(F.octet_length("html") >= LEAST_BYTES)
        .groupBy("digest")
        .agg(F.max("page_id").alias("response"), F.count("*").alias("n"))
        .where("n > 1 AND response IS NOT NULL")
        .select("digest", "response")
    )
    # Stored, so that its size is known: Spark sends it to the tasks if it is small, and joins by digest if not.
    joined = rows.join(stored(repeated, "responses"), "digest", "left")
    refers_to = F.when(F.col("page_id").eqNullSafe(F.col("response")), F.lit(None)).otherwise(F.col("response"))
    return joined.select("page_id", "url", "html", "digest", refers_to.alias("refers_to"))


def write_archives(pages: DataFrame, path: str, date: str | None = None) -> None:
    """Write ``pages`` (page_id, url, html) as deduplicated archives, gzip files of WARC records.

    Of equal payloads of at least ``LEAST_BYTES`` bytes that with the largest page_id is the
    response and the others revisit it; smaller ones are all responses. A null html is an empty
    payload, a null url has no target line. Rows without page_id are revisits where others
    have the payload, else responses; rows that repeat the largest page_id are all responses.
    An empty table makes no archive with records.
    """
    date = date or datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        records, held = [], 0
        for batch in batches:
            for row in batch.to_pylist():
                records.append(record(row["page_id"], row["url"], row["html"], row["digest"], row["refers_to"], date))
                held += len(records[-1])
                if held >= ARCHIVE_BYTES:
                    yield pa.RecordBatch.from_pydict({"archive": [BETWEEN.join(records)]})
                    records, held = [], 0
        if records:
            yield pa.RecordBatch.from_pydict({"archive": [BETWEEN.join(records)]})

    archives = with_revisits(pages).mapInArrow(run, "archive string")
    writer = archives.write.option("lineSep", BETWEEN).option("compression", "gzip")
    writer.option("maxRecordsPerFile", 1).option("zlib.compress.level", "BEST_SPEED").text(path)


def parse(archive: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and block of each record."""
    at = 0
    while (end := archive.find(b"\r\n\r\n", at)) >= 0:
        first, *lines = archive[at:end].decode().split("\r\n")
        if first != VERSION:
            raise ValueError(f"no record at byte {at} of the archive")
        headers = dict(line.split(": ", 1) for line in lines)
        length = int(headers["Content-Length"])
        yield headers, archive[end + 4 : end + 4 + length]
        at = end + 4 + length + len(BETWEEN)


_ENTRY = "page_id long, url string, record_type string, digest string, payload_bytes long, refers_to long"


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """page_id, url, record_type, payload_digest, payload_bytes and refers_to of every record.

    Digest and length of a response are those of the payload that is read, and an altered payload
    is an error; a revisit has those of the response it refers to.
    """

    def entry(headers: dict[str, str], block: bytes) -> dict:
        kind, stated = headers["WARC-Type"], headers["WARC-Payload-Digest"].removeprefix("sha1:")
        payload = block.partition(b"\r\n\r\n")[2]
        digest = hashlib.sha1(payload).hexdigest() if kind == "response" else base64.b32decode(stated).hex()
        if _base32(digest) != stated:
            raise ValueError(f"the payload of {headers['WARC-Record-ID']} is not the one it was written with")
        return {
            "page_id": _page_of(headers["WARC-Record-ID"]),
            "url": headers.get("WARC-Target-URI"),
            "record_type": kind,
            "digest": digest,
            "payload_bytes": len(payload) if kind == "response" else None,
            "refers_to": _page_of(headers["WARC-Refers-To"]) if kind == "revisit" else None,
        }

    kind = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("digest", pa.string()), ("payload_bytes", pa.int64()), ("refers_to", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column("content"):
                archive = zlib.decompress(content.as_buffer(), wbits=31)
                yield pa.RecordBatch.from_pylist([entry(*one) for one in parse(archive)], kind)

    files = spark.read.format("binaryFile").load(path).select("content")
    entries = stored(files.mapInArrow(run, _ENTRY), "entries")
    responses = entries.where("record_type = 'response'").groupBy(F.col("page_id").alias("__page"), "digest")
    # An equal page_id may be several responses; those with the digest are alike.
    responses = responses.agg(F.max("payload_bytes").alias("__bytes")).withColumnRenamed("digest", "__digest")
    joined = entries.join(responses, (F.col("refers_to") == F.col("__page")) & (F.col("digest") == F.col("__digest")), "left")
    return joined.select(
        "page_id",
        "url",
        "record_type",
        F.col("digest").alias("payload_digest"),
        F.coalesce("payload_bytes", "__bytes").alias("payload_bytes"),
        "refers_to",
    )
