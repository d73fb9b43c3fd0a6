"""WARC archives whose repeated payloads are revisit records, written and read through Spark.

Only headers (identifier, digest) are shuffled by payload digest to choose the one response of each
payload; payloads move once, to spread the archives evenly. Archives are written by Spark's own
committed writer, so a lost task leaves no broken file, to any file system Spark knows.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from placelytics.llm.shared import require

#: Mean bytes of payload in an archive; one archive is read whole by one task.
ARCHIVE_BYTES = 16 << 20
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_LINE = "\r\n"
_DIGITS, _BASE32 = "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
_READ = (
    "page_id long, record_id string, record_type string, url string, payload_digest string,"
    " payload_bytes long, refers_to_record string, payload binary"
)


def base32_sha1(payload: Column) -> Column:
    """The SHA-1 of a binary column in base32: five bytes are eight digits, four times."""
    hexed = F.sha1(payload)
    groups = [F.lpad(F.conv(F.substring(hexed, 10 * g + 1, 10), 16, 32), 8, "0") for g in range(4)]
    return F.translate(F.concat(*groups), _DIGITS, _BASE32)


def _record_id(page: Column) -> Column:
    """A URN that only depends on the page and the digest of its payload, so that a page may have several payloads."""
    parts = F.md5(F.concat(F.lit("page:"), F.coalesce(page.cast("string"), F.lit("null")), F.lit(":"), F.hex("digest")))
    return F.regexp_replace(parts, "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "<urn:uuid:$1-$2-$3-$4-$5>")


def _uri(url: Column) -> Column:
    """A url that fits a header line; a null has a name of its own."""
    return F.coalesce(F.replace(F.replace(url, F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A")), F.lit("urn:none"))


def _fields(**lines: Column) -> Column:
    return F.concat(*(F.concat(F.lit(f"{name.replace('_', '-')}: "), value, F.lit(_LINE)) for name, value in lines.items()))


def write_archives(
    pages: DataFrame, folder: str, *, id: str = "page_id", url: str = "url", html: str = "html", min_bytes: int = 0
) -> None:
    """Write one record per row of ``pages`` under ``folder``, gzipped.

    Of rows with equal payloads of at least ``min_bytes`` bytes, that with the largest id is a
    response and the others are revisits of it; rows with a smaller payload are responses. A null
    payload is empty. Rows that repeat both id and payload each get the same record; rows that repeat
    the id alone have records of their own; a null id loses to any other. An empty table writes no record.
    """
    require(pages, id, url, html)
    payload = F.coalesce(F.col(html).cast("binary"), F.lit(b""))
    rows = pages.select(F.col(id).cast("long").alias("id"), _uri(F.col(url)).alias("uri"), payload.alias("payload")).withColumn(
        "digest", F.unhex(F.sha1("payload"))
    )
    # One key for spreading the archives and for the join, so that payloads are shuffled once. Two
    # structs with a null in the same place are equal.
    key = F.struct("id", "digest")
    headers = rows.select("id", "uri", "digest", (F.octet_length("payload") >= min_bytes).alias("shared"))
    best = headers.where("shared").groupBy("digest").agg(F.max(F.struct("id", "uri")).alias("best"))
    decided = (
        headers.where("shared")
        .join(best, "digest")
        .where(~F.col("id").eqNullSafe(F.col("best.id")))
        .select(key.alias("key"), "best")
        .distinct()
    )
    size = pages.agg(F.sum(F.octet_length(F.col(html)))).first()[0] or 0
    files = max(1, -(-size // ARCHIVE_BYTES))
    spread = rows.withColumn("to", key).repartition(files, "to")
    records = spread.join(decided, F.col("to") == F.col("key"), "left")
    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
        F.octet_length("payload").cast("string"),
        F.lit(_LINE * 2),
    )
    digest = F.concat(F.lit("sha1:"), base32_sha1(F.col("payload")))
    page = F.coalesce(F.col("id").cast("string"), F.lit(""))
    common = {
        "WARC_Record_ID": _record_id(F.col("id")),
        "WARC_Date": F.lit(DATE),
        "WARC_Target_URI": F.col("uri"),
        "WARC_Payload_Digest": digest,
        "X_Page_Id": page,
        "Content_Type": F.lit("application/http; msgtype=response"),
    }
    response = F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: response\r\n"),
        _fields(**common, Content_Length=(F.octet_length(http) + F.octet_length("payload")).cast("string")),
        F.lit(_LINE),
        http,
        F.col("payload").cast("string"),
    )
    revisit = F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: revisit\r\n"),
        _fields(
            **common,
            WARC_Profile=F.lit(PROFILE),
            WARC_Refers_To=_record_id(F.col("best.id")),
            WARC_Refers_To_Target_URI=F.col("best.uri"),
            WARC_Refers_To_Date=F.lit(DATE),
            Content_Length=F.octet_length(http).cast("string"),
        ),
        F.lit(_LINE),
        http,
    )
    # A record ends with two empty lines: they are the writer's line separator.
    records.select(F.when(F.col("best").isNull(), response).otherwise(revisit).alias("value")).write.option(
        "lineSep", _LINE * 2
    ).option("compression", "gzip").text(folder)


def _records(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    at = 0
    while at < len(data):
        head_end = data.index(b"\r\n\r\n", at)
        first, *lines = data[at:head_end].decode().split(_LINE)
        if first != "WARC/1.1":
            raise ValueError(f"no WARC record at byte {at}")
        fields = dict(line.split(": ", 1) for line in lines)
        begin = head_end + 4
        end = begin + int(fields["Content-Length"])
        if data[end : end + 4] != b"\r\n\r\n":
            raise ValueError(f"the record at byte {at} has another length than it says")
        yield fields, data[begin:end]
        at = end + 4


def _parsed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for content in batch["content"]:
            rows = []
            for fields, block in _records(gzip.decompress(content)):
                body = block[block.index(b"\r\n\r\n") + 4 :]
                digest, full = fields["WARC-Payload-Digest"].removeprefix("sha1:"), fields["WARC-Type"] == "response"
                if full and base64.b32encode(hashlib.sha1(body).digest()).decode() != digest:
                    raise ValueError(f"{fields['WARC-Record-ID']}: the payload does not match its digest")
                rows.append(
                    (
                        int(fields["X-Page-Id"]) if fields["X-Page-Id"] else None,
                        fields["WARC-Record-ID"], fields["WARC-Type"], fields["WARC-Target-URI"], digest,
                        len(body) if full else None, fields.get("WARC-Refers-To"), body if full else None,
                    )
                )
            names = [c.split()[0] for c in _READ.split(",")]
            yield pd.DataFrame(rows, columns=names).astype({"page_id": "Int64", "payload_bytes": "Int64"})


def read_archives(spark: SparkSession, folder: str) -> DataFrame:
    """Every record under ``folder``; lengths and payload digests are checked."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(folder).select("content")
    return files.mapInPandas(_parsed, _READ)


def resolve_revisits(records: DataFrame) -> DataFrame:
    """``(page_id, payload_bytes, payload_digest, record_type, refers_to)`` of every record read.

    A revisit has the size of the payload it refers to, and refers to the page of that response.
    """
    slim = records.drop("payload", "url")
    originals = (
        slim.where("record_type = 'response'")
        .select(F.col("record_id").alias("original"), F.col("page_id").alias("refers_to"), F.col("payload_bytes").alias("original_bytes"))
        .distinct()
    )
    return slim.join(originals, F.col("refers_to_record") == F.col("original"), "left").select(
        "page_id",
        F.coalesce("payload_bytes", "original_bytes").alias("payload_bytes"),
        "payload_digest",
        "record_type",
        "refers_to",
    )
