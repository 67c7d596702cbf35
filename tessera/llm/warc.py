"""WARC archives with revisit resolution.

Headers (page id, payload digest) are shuffled by digest; a partial minimum per
digest finds the original, so a payload that a third of all pages share costs one
row a task. Records are built from columns and written by Spark as gzip text with
the record separator as line end, so each file is a WARC file. Reading parses
each file as a stream by Content-Length, recomputes the digests of responses and
joins revisits to the responses they refer to.

Edge cases: null html is an empty payload; null URLs have no target header and
control characters and blanks in URLs are percent-encoded; null page ids come
last (a payload with null ids only is all responses, and a null id is read back
as null); rows that share the smallest id of a payload are all responses; an
empty table writes no record and reads back none.
"""

from __future__ import annotations

import gzip
import hashlib
import io
import re
from base64 import b32encode

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import scratch

RECORDS_PER_FILE = 20_000
END = "\r\n\r\n"
URN = "urn:tessera:page:"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
DATE = "2024-01-01T00:00:00Z"      # the tables hold no capture time


def base32_sha1(c: Column) -> Column:
    """Upper-case base32 of the SHA-1 of a string's UTF-8 bytes: 4 groups of 40 bits."""
    hexed = F.sha1(c.cast("binary"))
    groups = [F.lpad(F.conv(F.substring(hexed, 1 + 10 * i, 10), 16, 32), 8, "0") for i in range(4)]
    return F.translate(F.concat(*groups), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def with_digests(pages: DataFrame) -> DataFrame:
    html = F.coalesce(F.col("html"), F.lit(""))
    return pages.select("page_id", "url", html.alias("html"), F.octet_length(html).cast("bigint").alias("bytes"),
                        base32_sha1(html).alias("digest"))


def resolved(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """with_digests() rows and `original`: the id of the response that the row revisits, else null."""
    rows = with_digests(pages)
    first = (rows.where(F.col("bytes") >= min_bytes).groupBy("digest")
             .agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n"))
    repeat = (F.col("bytes") >= min_bytes) & F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    return (rows.join(first, "digest", "left")
            .select("page_id", "url", "html", "bytes", "digest", F.when(repeat, F.col("first")).alias("original")))


def records(rows: DataFrame) -> DataFrame:
    """One WARC record a row, as text without its final separator."""
    def urn(c):
        return F.concat(F.lit(f"<{URN}"), F.coalesce(c.cast("string"), F.lit("null")), F.lit(">"))

    url = F.col("url")
    for raw, coded in (("\r", "%0D"), ("\n", "%0A"), (" ", "%20"), ("\t", "%09")):
        url = F.replace(url, F.lit(raw), F.lit(coded))
    target = F.when(F.col("url").isNotNull() & (F.col("url") != ""),
                    F.concat(F.lit("WARC-Target-URI: "), url, F.lit("\r\n"))).otherwise("")
    again = F.col("original").isNotNull()
    size = F.when(again, F.lit(len(HTTP))).otherwise(F.lit(len(HTTP)) + F.col("bytes"))
    return rows.select(F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: "), F.when(again, "revisit").otherwise("response"),
        F.lit("\r\nWARC-Record-ID: "), urn(F.col("page_id")), F.lit(f"\r\nWARC-Date: {DATE}\r\n"), target,
        F.lit("WARC-Payload-Digest: sha1:"), F.col("digest"), F.lit("\r\n"),
        F.when(again, F.concat(F.lit("WARC-Refers-To: "), urn(F.col("original")),
                               F.lit(f"\r\nWARC-Profile: {PROFILE}\r\n"))).otherwise(""),
        F.lit("Content-Type: application/http; msgtype=response\r\nContent-Length: "), size.cast("string"),
        F.lit(END), F.lit(HTTP), F.when(again, "").otherwise(F.col("html"))).alias("value"))


def write_archives(pages: DataFrame, path: str, min_bytes: int = 0) -> None:
    """Deduplicated archives of pages(page_id, url, html) below a shared folder."""
    (records(resolved(pages, min_bytes)).write.mode("overwrite").option("compression", "gzip")
     .option("lineSep", END).option("maxRecordsPerFile", RECORDS_PER_FILE).text(path))


def parse(stream):
    """Header dictionary and block of each record of an open WARC file."""
    while True:
        line = stream.readline()
        if not line:
            return
        if line == b"\r\n":
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"not a WARC record: {line[:40]!r}")
        head = {}
        while (line := stream.readline()) not in (b"\r\n", b""):
            name, _, value = line.decode().partition(":")
            head[name.strip().lower()] = value.strip()
        size = int(head["content-length"])
        block = stream.read(size)
        if len(block) != size:
            raise ValueError("a WARC record ends early")
        yield head, block


READ = pa.schema([("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
                  ("record_type", pa.string()), ("refers_to", pa.int64())])
READ_DDL = "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint"


def _page(urn: str | None) -> int | None:
    found = re.fullmatch(rf"<{URN}(-?\d+)>", urn or "")
    return int(found[1]) if found else None


def read_headers(spark: SparkSession, path: str) -> DataFrame:
    """A row a record; payload_bytes of revisits is null. A response whose digest differs from its header fails."""
    def rows(batches):
        for batch in batches:
            for content in batch.column("content"):
                out = []
                with gzip.open(io.BytesIO(content.as_py())) as stream:
                    for head, block in parse(io.BufferedReader(stream)):
                        digest = head["warc-payload-digest"].removeprefix("sha1:")
                        n = None
                        if head["warc-type"] == "response":
                            payload = block.partition(b"\r\n\r\n")[2]
                            n = len(payload)
                            if b32encode(hashlib.sha1(payload).digest()).decode() != digest:
                                raise ValueError(f"digest of {head['warc-record-id']} does not fit its payload")
                        out.append((_page(head["warc-record-id"]), n, digest, head["warc-type"],
                                    _page(head.get("warc-refers-to"))))
                        if len(out) >= 5000:
                            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), READ)], schema=READ)
                            out = []
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), READ)], schema=READ)

    return spark.read.format("binaryFile").load(path).select("content").mapInArrow(rows, READ_DDL)


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """All records, revisits with the payload size of the response that they refer to."""
    rows = read_headers(spark, path)
    original = (rows.where("record_type = 'response'").groupBy(F.col("payload_digest").alias("digest"))
                .agg(F.max("payload_bytes").alias("bytes")))
    revisits = (rows.where("record_type = 'revisit'").join(original, F.col("payload_digest") == F.col("digest"), "left")
                .select("page_id", F.col("bytes").alias("payload_bytes"), "payload_digest", "record_type", "refers_to"))
    return rows.where("record_type = 'response'").unionByName(revisits)


def archived(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Writes the archives to the shared folder and reads them back."""
    path = f"{scratch(pages.sparkSession)}/warc"
    write_archives(pages, path, min_bytes)
    return read_archives(pages.sparkSession, path)
