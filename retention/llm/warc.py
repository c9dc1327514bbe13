"""A content-addressed archive of WARC records.

The archive is two tables in a folder that all executors share: ``payloads`` keeps the bytes of each
distinct payload once, under its SHA-256 digest and size; ``records`` keeps each record's exact
header bytes (WARC header and HTTP header) and the digest. The first page (smallest id) of those with
equal payloads of at least ``MIN_REVISIT`` bytes is a ``response``, the others are ``revisit``
records that refer to it; smaller payloads are all responses. A record is rebuilt by joining its
header with its payload; every payload's digest is computed anew when it is read, and a mismatch
or a payload that is missing is an error.

Payloads are grouped by digest, one of equal ones leaving each task, and stored in a table bucketed by
digest, so payload bytes move once. Records meet them there; those of a payload with more than
``MANY_COPIES`` records meet it in ``SALTS`` parts instead, so that it is no hot task.

Defined cases: null html: an empty payload; null url: an empty target; line breaks in a url are
written %0D and %0A; rows that share the smallest page_id of a payload are all responses; null
page_ids never are the first of others, but are responses if a payload has no other ids; empty
table: an empty archive.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from retention.session import scratch_path

MIN_REVISIT = 100
#: Records of a payload beyond which they are joined in so many parts.
MANY_COPIES, SALTS = 1_000, 32
CRLF = "\r\n"
PAYLOADS = "digest string, size bigint, first bigint, copies bigint, payload binary"


@dataclass(frozen=True)
class Archive:
    """Paths of the two tables, and the second one's name in the session's catalog, if it is there."""

    records: str
    payloads: str
    table: str | None = None


def _lines(*parts: Column | str) -> Column:
    return F.concat(*(F.lit(p) if isinstance(p, str) else p for p in parts))


def _headers() -> Column:
    """A record's exact header text, from page_id, url, digest, size, record_type and refers_to."""
    page = F.coalesce(F.col("page_id").cast("string"), F.lit(""))
    target = F.regexp_replace(F.regexp_replace(F.coalesce("url", F.lit("")), "\r", "%0D"), "\n", "%0A")
    http = _lines(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: ", F.col("size").cast("string"), CRLF + CRLF)
    revisit = F.col("record_type") == "revisit"
    refers = F.when(revisit, _lines(f"{CRLF}WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest{CRLF}WARC-Refers-To: <urn:page:", F.col("refers_to").cast("string"), ">")).otherwise(F.lit(""))
    length = F.octet_length(http) + F.when(revisit, 0).otherwise(F.col("size"))
    return _lines(
        f"WARC/1.1{CRLF}WARC-Type: ", F.col("record_type"), f"{CRLF}WARC-Record-ID: <urn:page:", page, f">{CRLF}WARC-Date: 1970-01-01T00:00:00Z{CRLF}WARC-Target-URI: ", target,
        refers, f"{CRLF}WARC-Payload-Digest: sha256:", F.col("digest"), f"{CRLF}Content-Type: application/http; msgtype=response{CRLF}Content-Length: ", length.cast("string"), CRLF + CRLF, http,
    )


def write_archive(pages: DataFrame, folder: str, min_revisit: int = MIN_REVISIT) -> Archive:
    """Writes a record for each row of ``pages`` (page_id, url, html)."""
    archive = Archive(f"{folder}/records", f"{folder}/payloads", f"payloads_{uuid.uuid4().hex[:12]}")
    rows = pages.select("page_id", "url", F.coalesce(F.col("html"), F.lit("")).cast("binary").alias("payload"))
    rows = rows.select("page_id", "url", F.sha2("payload", 256).alias("digest"), F.octet_length("payload").cast("bigint").alias("size"), "payload")
    spark = pages.sparkSession
    distinct = rows.groupBy("digest").agg(F.first("size").alias("size"), F.min("page_id").alias("first"), F.count("*").alias("copies"), F.first("payload").alias("payload"))
    buckets = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    distinct.write.bucketBy(buckets, "digest").option("path", archive.payloads).option("compression", "zstd").saveAsTable(archive.table)
    # read without its buckets: both sides of this light join are shuffled, so Spark can split a frequent digest
    firsts = spark.read.schema(PAYLOADS).parquet(archive.payloads).select("digest", "first", "copies")

    again = (F.col("size") >= min_revisit) & ~F.col("page_id").eqNullSafe(F.col("first"))
    records = (
        rows.drop("payload").join(firsts, "digest")
        .withColumn("record_type", F.when(again, "revisit").otherwise("response"))
        .withColumn("refers_to", F.when(again, F.col("first")))
        .select(_headers().cast("binary").alias("header"), "digest", "copies")
    )
    records.write.parquet(archive.records)
    return archive


def read_archive(spark: SparkSession, archive: Archive) -> DataFrame:
    """(header, payload, digest): the original records rebuilt; raises on a payload that doesn't have
    its digest or isn't there."""
    stored = spark.table(archive.table) if archive.table else spark.read.schema(PAYLOADS).parquet(archive.payloads)
    damaged = F.raise_error(F.concat(F.lit("payload is damaged: "), F.col("digest")))
    whole = (F.sha2("payload", 256) == F.col("digest")) & (F.octet_length("payload") == F.col("size"))
    checked = stored.select("digest", "copies", F.when(whole, F.col("payload")).otherwise(damaged).alias("payload"))
    records = spark.read.parquet(archive.records)
    many = F.col("copies") > MANY_COPIES
    few = records.where(~many).drop("copies").join(checked.where(~many).drop("copies"), "digest", "left")
    salted = records.where(many).drop("copies").withColumn("_salt", F.pmod(F.xxhash64("header"), F.lit(SALTS)).cast("int"))
    parts = checked.where(many).drop("copies").withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    joined = few.unionByName(salted.join(parts, ["digest", "_salt"], "left").drop("_salt"))
    missing = F.raise_error(F.concat(F.lit("payload is missing: "), F.col("digest")))
    return joined.select("header", F.when(F.col("payload").isNotNull(), F.col("payload")).otherwise(missing).alias("payload"), "digest")


def record_bytes(records: DataFrame) -> DataFrame:
    """(record): each rebuilt record as it stands in a WARC file; a revisit's block has no payload."""
    revisit = F.col("header").cast("string").startswith(f"WARC/1.1{CRLF}WARC-Type: revisit{CRLF}")
    body = F.when(revisit, F.lit(b"")).otherwise(F.col("payload"))
    return records.select(F.concat("header", body, F.lit((CRLF * 2).encode())).alias("record"))


def parsed(records: DataFrame) -> DataFrame:
    """A row per rebuilt record, read from its header text and its payload's bytes."""
    text = F.col("header").cast("string")

    def field(pattern: str) -> Column:
        return F.regexp_extract(text, f"\r\n{pattern}\r\n", 1)

    return records.select(
        F.nullif(field("WARC-Record-ID: <urn:page:(-?[0-9]*)>"), F.lit("")).cast("bigint").alias("page_id"),
        F.octet_length("payload").cast("bigint").alias("payload_bytes"),
        field("WARC-Payload-Digest: sha256:([0-9a-f]{64})").alias("payload_digest"),
        field("WARC-Type: ([a-z]+)").alias("record_type"),
        F.nullif(field("WARC-Refers-To: <urn:page:(-?[0-9]*)>"), F.lit("")).cast("bigint").alias("refers_to"),
    )


def archive_round_trip(pages: DataFrame) -> DataFrame:
    """Writes the pages' archive to the shared folder and reads its records back."""
    spark = pages.sparkSession
    return parsed(read_archive(spark, write_archive(pages, scratch_path(spark, "warc"))))


#: The same rows from the pages themselves.
ORACLE_SQL = """
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages
), f AS (
  SELECT *, min(page_id) OVER (PARTITION BY payload_digest, payload_bytes) AS first FROM p
)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN payload_bytes >= 100 AND page_id IS DISTINCT FROM first THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 100 AND page_id IS DISTINCT FROM first THEN first END AS refers_to
FROM f
"""
