"""A content-addressed WARC archive: payloads once by digest, exact record headers beside them.

``write_archive`` makes two tables below a folder: ``payloads`` (SHA-256, bytes), one row for each different
payload, and ``headers`` (record number, exact header bytes, SHA-256). ``read_archive`` joins them back to whole records and
parses those; a payload that doesn't have the digest it is stored under, or a header that contradicts
its payload, raises an error. ``record_bytes`` gives the record as it stands in a WARC file.

Of records with equal payloads of at least ``revisit_bytes``, the one with the largest page id is the response and the
others revisit it; a revisit record has no payload of its own in its WARC form, and the archive
still rebuilds the full one. A null page id is smaller than any other; if rows repeat the largest page id with the same
payload, all of them are responses. A null payload is empty; a null URL leaves its header line
out, and control characters and blanks in URLs are percent-encoded. Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from recordloom.session import scratch_path, stage

_PAGE_URN = "urn:page:"
#: WARC asks for a date of capture; pages have none.
NO_DATE = "1970-01-01T00:00:00Z"


def _target(url: Column) -> Column:
    """The URL without bytes that would break a header line."""
    for number in [*range(33), 127]:
        url = F.replace(url, F.lit(chr(number)), F.lit(f"%{number:02X}"))
    return url


def _header_lines() -> Column:
    page = F.coalesce(F.col("page_id").cast("string"), F.lit(""))
    referred = F.when(F.col("refers_to").isNotNull(), F.concat(F.lit(f"WARC-Refers-To: <{_PAGE_URN}"), F.col("refers_to").cast("string"), F.lit(">")))
    return F.concat(
        F.concat_ws(
            "\r\n",
            F.lit("WARC/1.1"),
            F.concat(F.lit("WARC-Type: "), F.col("record_type")),
            F.concat(F.lit(f"WARC-Record-ID: <{_PAGE_URN}"), page, F.lit(">")),
            F.lit(f"WARC-Date: {NO_DATE}"),
            F.concat(F.lit("WARC-Target-URI: "), _target(F.col("url"))),
            F.concat(F.lit("WARC-Payload-Digest: sha1:"), F.col("sha1")),
            referred,
            F.lit("Content-Type: text/html; charset=utf-8"),
            F.concat(F.lit("WARC-Payload-Length: "), F.col("bytes").cast("string")),
            F.concat(F.lit("Content-Length: "), F.when(F.col("record_type") == "revisit", 0).otherwise(F.col("bytes")).cast("string")),
        ),
        F.lit("\r\n\r\n"),
    ).cast("binary")


def write_archive(pages: DataFrame, folder: str | None = None, revisit_bytes: int = 1000) -> str:
    """Write the records of ``pages`` (page_id, url, html) and return the archive's folder."""
    spark = pages.sparkSession
    folder = folder or scratch_path(spark, "warc")
    payload = F.coalesce("html", F.lit("")).cast("binary")
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), payload.alias("payload"),
        F.unhex(F.sha2(payload, 256)).alias("sha256"),
    )
    # One copy of each payload; a second digest and the length confirm that equal keys mean equal bytes.
    stored = rows.groupBy("sha256").agg(
        F.max("payload").alias("payload"), F.min(F.sha1("payload")).alias("sha1"), F.max(F.sha1("payload")).alias("other"),
        F.max("page_id").alias("largest"), F.count("*").alias("records"),
    )
    agreed = F.when(F.col("sha1") == F.col("other"), F.col("sha1")).otherwise(
        F.raise_error(F.concat(F.lit("different payloads share the SHA-256 "), F.hex("sha256")))
    )
    stored.withColumn("sha1", agreed).drop("other").write.parquet(f"{folder}/payloads")
    narrow = rows.select("page_id", "url", "sha256")
    known = spark.read.parquet(f"{folder}/payloads").select("sha256", "sha1", F.octet_length("payload").cast("long").alias("bytes"), "largest", "records")
    # written, so that both sides are plain and Spark may split a payload that many pages share
    known = stage(known, "payload-facts")
    revisits = (F.col("bytes") >= revisit_bytes) & ~F.col("page_id").eqNullSafe(F.col("largest"))
    records = (
        narrow.join(known, "sha256")
        .withColumn("record_type", F.when(revisits, "revisit").otherwise("response"))
        .withColumn("refers_to", F.when(revisits, F.col("largest")))
    )
    records.select(_header_lines().alias("header"), "sha256").write.parquet(f"{folder}/headers")
    return folder


def _field(name: str, pattern: str) -> Column:
    found = F.regexp_extract(F.col("header").cast("string"), rf"\r\n{name}: {pattern}\r\n", 1)
    return F.when(found != "", found)


def read_archive(spark: SparkSession, folder: str) -> DataFrame:
    """``page_id, url, header, payload, payload_bytes, payload_digest, record_type, refers_to`` of every record."""
    headers = spark.read.parquet(f"{folder}/headers")
    payloads = spark.read.parquet(f"{folder}/payloads").select("sha256", "payload", F.sha1("payload").alias("sha1"))
    checked = payloads.withColumn(
        "payload",
        F.when(F.unhex(F.sha2("payload", 256)) == F.col("sha256"), F.col("payload")).otherwise(
            F.raise_error(F.concat(F.lit("damaged payload "), F.hex("sha256")))
        ),
    )
    return (
        headers.join(checked, "sha256")
        .select(
            _field("WARC-Record-ID", rf"<{_PAGE_URN}(-?\d+)>").cast("long").alias("page_id"),
            _field("WARC-Target-URI", r"([^\r]*)").alias("url"),
            "header",
            "payload",
            F.octet_length("payload").cast("long").alias("payload_bytes"),
            F.when(_field("WARC-Payload-Digest", r"sha1:([0-9a-f]+)") == F.col("sha1"), F.col("sha1"))
            .otherwise(F.raise_error(F.lit("a header contradicts its payload"))).alias("payload_digest"),
            _field("WARC-Type", r"([a-z]+)").alias("record_type"),
            _field("WARC-Refers-To", rf"<{_PAGE_URN}(-?\d+)>").cast("long").alias("refers_to"),
        )
    )


def record_bytes() -> Column:
    """The WARC record of a row of ``read_archive``; revisits carry no payload."""
    body = F.when(F.col("record_type") == "revisit", F.lit(b"")).otherwise(F.col("payload"))
    return F.concat("header", body, F.lit(b"\r\n\r\n"))
