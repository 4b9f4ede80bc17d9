"""Content-addressed WARC archive.

A payload is stored once, under the SHA-256 of its bytes; the exact header of every record is kept apart, with the
key of its payload. Records come back by joining the two, and a payload that doesn't have the digest it is stored
under, or that its record's header names, ends the read with an error.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trailseq.session import scratch_path

LEAST_REVISIT_BYTES = 1000
#: The time of capture that headers carry where the pages have none.
UNDATED = "1970-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
CRLF = "\r\n"


@dataclass
class Archive:
    """The folders of an archive; ``headers`` has a row per record, ``payloads`` one per distinct payload."""

    path: str

    def headers(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema("page_id bigint, header string, payload_key string").parquet(f"{self.path}/headers")

    def payloads(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema("payload_key string, payload binary").parquet(f"{self.path}/payloads")


def _record_id(page_id):
    return F.concat(F.lit("<urn:x-page:"), F.coalesce(page_id.cast("string"), F.lit("none")), F.lit(">"))


def _line(name: str, value):
    return F.when(value.isNotNull(), F.concat(F.lit(f"{name}: "), value, F.lit(CRLF))).otherwise(F.lit(""))


def write(pages: DataFrame, path: str | None = None, least_revisit_bytes: int = LEAST_REVISIT_BYTES) -> Archive:
    """Archive ``pages`` (page_id, url, html), one record per row; other columns are left out.

    The payload is the html in UTF-8, nothing for NULL. Of the records with equal payloads of at least
    ``least_revisit_bytes`` bytes the one with the largest page_id is the response and the others revisit it; repeated
    rows of that page_id are responses each. A group whose page_ids are all NULL has responses only. An
    empty table makes an empty archive. Control characters and spaces in a url are percent-encoded in its header.
    """
    spark = pages.sparkSession
    archive = Archive(path or scratch_path(spark, "warc"))
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    keyed = pages.select(F.col("page_id").cast("bigint").alias("page_id"), "url", payload.alias("payload")).withColumn(
        "payload_key", F.sha2("payload", 256))
    keyed.groupBy("payload_key").agg(F.first("payload").alias("payload")).write.parquet(f"{archive.path}/payloads")

    narrow = keyed.select("page_id", "url", "payload_key", F.octet_length("payload").alias("size"),
                          F.sha1("payload").alias("digest"))
    latest = narrow.where(F.col("size") >= least_revisit_bytes).groupBy("payload_key").agg(
        F.max("page_id").alias("latest"))
    typed = narrow.join(latest, "payload_key", "left").withColumn(
        "revisit", F.coalesce(~F.col("page_id").eqNullSafe(F.col("latest")), F.lit(False)) & F.col("latest").isNotNull())
    url = F.col("url")
    for code in [*range(0x21), 0x7F]:
        url = F.replace(url, F.lit(chr(code)), F.lit(f"%{code:02X}"))
    header = F.concat(
        F.lit(f"WARC/1.1{CRLF}WARC-Type: "), F.when(F.col("revisit"), "revisit").otherwise("response"), F.lit(CRLF),
        F.lit("WARC-Record-ID: "), _record_id(F.col("page_id")), F.lit(CRLF),
        F.lit(f"WARC-Date: {UNDATED}{CRLF}"),
        _line("WARC-Target-URI", url),
        F.lit("WARC-Payload-Digest: sha1:"), F.col("digest"), F.lit(CRLF),
        F.when(F.col("revisit"), F.concat(
            F.lit(f"WARC-Profile: {PROFILE}{CRLF}WARC-Refers-To: "), _record_id(F.col("latest")), F.lit(CRLF),
        )).otherwise(F.lit("")),
        F.lit(f"Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "),
        F.when(F.col("revisit"), F.lit(0)).otherwise(F.col("size")).cast("string"), F.lit(CRLF + CRLF),
    )
    typed.select("page_id", header.alias("header"), "payload_key").write.parquet(f"{archive.path}/headers")
    return archive


def read(spark: SparkSession, archive: Archive) -> DataFrame:
    """All records: page_id, header, the full payload (of a revisit: its response's), and the record's own bytes."""
    stored = archive.payloads(spark).withColumn("payload", F.when(
        F.sha2("payload", 256) == F.col("payload_key"), F.col("payload")).otherwise(
        F.raise_error(F.concat(F.lit("damaged payload "), F.col("payload_key")))))
    joined = archive.headers(spark).join(stored, "payload_key", "left")
    revisit = F.col("header").contains(f"WARC-Type: revisit{CRLF}")
    payload = F.coalesce(F.col("payload"), F.raise_error(F.concat(F.lit("no payload "), F.col("payload_key"))))
    return joined.select("page_id", "header", payload.alias("payload")).withColumn(
        "record", F.concat(F.col("header").cast("binary"),
                           F.when(revisit, F.lit(b"")).otherwise(F.col("payload")), F.lit(f"{CRLF}{CRLF}".encode())))


def index(records: DataFrame) -> DataFrame:
    """What the records' headers say, checked against the payloads.

    page_id, payload_bytes, payload_digest (hex SHA-1 of the full payload), record_type, refers_to.
    """
    field = lambda name: F.regexp_extract("header", rf"\r\n{name}: ([^\r]*)\r\n", 1)
    digest = F.sha1("payload")
    named = F.regexp_extract(field("WARC-Payload-Digest"), "sha1:(.*)", 1)
    refers = F.regexp_extract(field("WARC-Refers-To"), "<urn:x-page:([0-9-]+)>", 1)
    return records.select(
        "page_id", F.octet_length("payload").cast("bigint").alias("payload_bytes"),
        F.when(named == digest, digest).otherwise(F.raise_error(F.lit("payload and header differ"))).alias(
            "payload_digest"),
        field("WARC-Type").alias("record_type"), refers.try_cast(
            "bigint").alias("refers_to"))
