"""WARC archives without repeated payloads: revisit records that refer to one response.

Only headers (page id, digest, size) are shuffled by digest to settle which
page answers for a payload; the verdicts then join the pages by id, so payloads
move once and no digest, however common, gathers its payloads in one task.

Archives are plain WARC/1.1 files. Spark's text writer puts them into the
shared folder: a record is one line, ended by the two line breaks that close a
WARC record.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from notemill.llm.common import NULL_ID, real_id
from notemill.session import scratch_path

# Fixed values of the format.
VERSION = "WARC/1.1"
END_OF_RECORD = "\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

MIN_BYTES = 1000              # smaller payloads are always stored
RECORDS_PER_FILE = 2000       # bounds what a reader of one archive holds
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def headers(pages: DataFrame) -> DataFrame:
    """(_id, _url, _payload, _digest, _bytes) of every page; NULL html is an empty payload."""
    payload = F.coalesce(F.col("html").cast("string"), F.lit(""))
    return pages.select(
        F.coalesce(F.col("page_id").cast("bigint"), F.lit(NULL_ID)).alias("_id"), F.coalesce(F.col("url").cast("string"), F.lit("")).alias("_url"),
        payload.alias("_payload"), F.sha1(payload.cast("binary")).alias("_digest"), F.octet_length(payload).cast("bigint").alias("_bytes"),
    )


def revisits(heads: DataFrame, min_bytes: int = MIN_BYTES) -> DataFrame:
    """(_id, _digest, _refers) of the pages whose payload another page answers for: the one of largest id.

    Pages of one id and one payload are the same record: they answer together.
    """
    known = heads.filter(F.col("_bytes") >= min_bytes).select("_id", "_digest")
    answers = known.groupBy("_digest").agg(F.max("_id").alias("_refers"), F.min("_id").alias("_least")).filter("_least < _refers")
    return known.join(answers.select("_digest", "_refers"), "_digest").filter("_id < _refers").select("_id", "_digest", "_refers").distinct()


def _base32_of_hex(digest: Column) -> Column:
    """The 32 letters of a SHA-1 (40 hex digits), as WARC digests are written: 20 bits, 4 letters at a time."""
    def letters(at: int) -> list[Column]:
        value = F.conv(F.substring(digest, at * 5 + 1, 5), 16, 10).cast("int")
        return [F.substring(F.lit(BASE32), F.shiftright(value, 15 - 5 * k).bitwiseAND(31) + 1, F.lit(1)) for k in range(4)]

    return F.concat(*[letter for at in range(8) for letter in letters(at)])


def records(pages: DataFrame, date: str = "2025-01-01T00:00:00Z", min_bytes: int = MIN_BYTES) -> DataFrame:
    """(_id, record string) of every page, a response or a revisit with headers written anew."""
    heads = headers(pages)
    placed = heads.join(revisits(heads.select("_id", "_digest", "_bytes"), min_bytes), ["_id", "_digest"], "left")
    name = lambda c: F.concat(F.lit("<urn:page:"), F.when(F.col(c) == NULL_ID, F.lit("none")).otherwise(F.col(c).cast("string")), F.lit(">"))
    again = F.col("_refers").isNotNull()
    # Line breaks in a URL would end the header.
    url = F.regexp_replace("_url", r"[\r\n]", "")
    lines = [
        F.lit(VERSION), F.concat(F.lit("WARC-Type: "), F.when(again, "revisit").otherwise("response")),
        F.concat(F.lit("WARC-Record-ID: "), name("_id")), F.lit(f"WARC-Date: {date}"), F.concat(F.lit("WARC-Target-URI: "), url),
        F.concat(F.lit("WARC-Payload-Digest: sha1:"), _base32_of_hex(F.col("_digest"))),
        F.when(again, F.concat(F.lit("WARC-Refers-To: "), name("_refers"))), F.when(again, F.lit(f"WARC-Profile: {PROFILE}")),
        F.when(again, F.concat(F.lit("WARC-Refers-To-Payload-Length: "), F.col("_bytes").cast("string"))),
        F.lit("Content-Type: text/html; charset=utf-8"),
        F.concat(F.lit("Content-Length: "), F.when(again, F.lit(0)).otherwise(F.col("_bytes")).cast("string")),
    ]
    body = F.when(again, F.lit("")).otherwise(F.col("_payload"))
    return placed.select("_id", F.concat(F.concat_ws("\r\n", *lines), F.lit("\r\n\r\n"), body).alias("record"))


def write_archives(rows: DataFrame, path: str, records_per_file: int = RECORDS_PER_FILE) -> None:
    """Write records as WARC files below ``path``."""
    out = rows.select("record").write.option("lineSep", END_OF_RECORD).option("maxRecordsPerFile", records_per_file)
    out.option("compression", "gzip").text(path)


HEAD_LINE = re.compile(rb"([^:\r\n]+): ?([^\r\n]*)")


def parse_archive(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, content) of the records of one archive, by their lengths alone."""
    at = 0
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        head = {k.decode(): v.decode() for k, v in HEAD_LINE.findall(data[at:end].partition(b"\r\n")[2])}
        start = end + 4
        at = start + int(head["Content-Length"])
        yield head, data[start:at]
        at += len(END_OF_RECORD)


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """(_id, record_type, payload_bytes, payload_digest, _refers) of all records below ``path``.

    Sizes and digests of responses are computed from the stored payload; a
    revisit has them from its headers. A response that does not match its own
    digest raises.
    """
    import base64
    import gzip

    def of(name: str) -> int:
        text = name.removeprefix("<urn:page:").removesuffix(">")
        return NULL_ID if text == "none" else int(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data in batch.column(0):
                rows = []
                for head, content in parse_archive(gzip.decompress(data.as_buffer())):
                    stated = base64.b32decode(head["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
                    again = head["WARC-Type"] == "revisit"
                    if not again and hashlib.sha1(content).hexdigest() != stated:
                        raise ValueError(f"payload of {head['WARC-Record-ID']} does not match its digest")
                    rows.append((
                        of(head["WARC-Record-ID"]), head["WARC-Type"], int(head["WARC-Refers-To-Payload-Length"]) if again else len(content),
                        stated, of(head["WARC-Refers-To"]) if again else None,
                    ))
                if rows:
                    ids, kinds, sizes, digests, refers = map(list, zip(*rows, strict=True))
                    yield pa.RecordBatch.from_pydict({
                        "_id": pa.array(ids, pa.int64()), "record_type": kinds, "payload_bytes": pa.array(sizes, pa.int64()),
                        "payload_digest": digests, "_refers": pa.array(refers, pa.int64()),
                    })

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.txt.gz").load(path).select("content")
    return files.mapInArrow(run, "_id bigint, record_type string, payload_bytes bigint, payload_digest string, _refers bigint")


def deduplicated(pages: DataFrame, min_bytes: int = MIN_BYTES) -> DataFrame:
    """Write ``pages`` as archives, read them back: one row per page.

    page_id, payload_bytes, payload_digest (of the full payload), record_type,
    refers_to. NULL html is an empty payload, NULL urls are empty. A NULL
    page_id stays NULL and counts as smaller than all others. Rows repeated with
    the same id and payload get the same verdict. Empty tables give no record.
    """
    spark = pages.sparkSession
    folder = scratch_path(spark, "warc")
    write_archives(records(pages, min_bytes=min_bytes), folder)
    back = read_archives(spark, folder)
    return back.select(
        real_id("_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type",
        F.when(F.col("record_type") == "revisit", real_id("_refers")).alias("refers_to"),
    )


#: The same verdicts in DuckDB.
REVISIT_SQL = f"""
WITH heads AS (
    SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages
), best AS (
    SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS largest FROM heads
)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= {MIN_BYTES} AND page_id < largest THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= {MIN_BYTES} AND page_id < largest THEN largest END AS refers_to
FROM best
"""
