"""WARC archives: writing, reading back, and resolving equal payloads into revisit records.

An archive is a folder of gzip files of WARC/1.1 records, written and read by Spark's text source. Each record
carries a mark that is drawn afresh when its archive is written, so no payload can hold it; records are split
at the mark, and their Content-Length is checked.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from meetmart.sources.scratch import materialized, shared_dir

_EOL = "\r\n"
_GAP = _EOL + _EOL
_BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
_HTTP = f"HTTP/1.1 200 OK{_EOL}Content-Type: text/html; charset=utf-8"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def base32_sha1(payload: Column) -> Column:
    """Bare upper-case base32 SHA-1 of the text in UTF-8; five hex digits make four letters."""
    digest = F.sha1(payload.cast("binary"))
    letters = []
    for k in range(0, 40, 5):
        bits = F.conv(F.substring(digest, k + 1, 5), 16, 10).cast("int")
        letters += [
            F.substring(F.lit(_BASE32), F.shiftright(bits, s).bitwiseAND(31) + 1, F.lit(1)) for s in (15, 10, 5, 0)
        ]
    return F.concat(*letters)


def page_records(pages: DataFrame) -> DataFrame:
    """Response records of pages (page_id, url, html). Null html is an empty payload."""
    payload = F.coalesce(F.col("html").cast("string"), F.lit(""))
    return pages.select(
        F.expr("uuid()").alias("record_id"),
        F.lit("response").alias("record_type"),
        F.col("page_id").cast("long").alias("page_id"),
        F.regexp_replace(F.col("url").cast("string"), r"[\x00-\x20\x7f]", "%20").alias("url"),
        base32_sha1(payload).alias("payload_digest"),
        F.lit(None).cast("string").alias("refers_to_record"),
        F.lit(None).cast("long").alias("refers_to"),
        payload.alias("payload"),
    )


def write_archive(records: DataFrame, path: str) -> str:
    """Writes records with fresh headers and returns the archive's mark. Revisits carry no payload."""
    mark = uuid.uuid4().hex

    def header(name: str, value: Column) -> Column:
        return F.coalesce(F.concat(F.lit(f"{name}: "), value.cast("string"), F.lit(_EOL)), F.lit(""))

    revisit = F.col("record_type") == "revisit"
    body = F.when(revisit, "").otherwise(F.col("payload"))
    http = F.concat(
        F.lit(_HTTP + _EOL), header("Content-Length", F.octet_length("payload")), F.lit(_EOL)
    )
    text = F.concat(
        F.lit(f"WARC/1.1{_EOL}WARC-Archive-Mark: {mark}{_EOL}"),
        header("WARC-Type", F.col("record_type")),
        header("WARC-Record-ID", F.concat(F.lit("<urn:uuid:"), "record_id", F.lit(">"))),
        header("WARC-Date", F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss'Z'")),
        header("WARC-Target-URI", F.col("url")),
        header("WARC-Payload-Digest", F.concat(F.lit("sha1:"), "payload_digest")),
        header("WARC-Refers-To", F.concat(F.lit("<urn:uuid:"), "refers_to_record", F.lit(">"))),
        header("WARC-Profile", F.when(revisit, F.lit(_PROFILE))),
        header("X-Page-Id", F.col("page_id")),
        header("X-Refers-To-Page-Id", F.col("refers_to")),
        F.lit(f"Content-Type: application/http; msgtype=response{_EOL}"),
        header("Content-Length", F.octet_length(http) + F.octet_length(body)),
        F.lit(_EOL),
        http,
        body,
    )
    records.select(text.alias("value")).write.option("lineSep", _GAP).option("compression", "gzip").text(path)
    return mark


def read_archive(spark: SparkSession, path: str, mark: str) -> DataFrame:
    """Records of an archive; a record whose length is not as its header says is an error."""
    lines = (
        spark.read.option("lineSep", f"WARC/1.1{_EOL}WARC-Archive-Mark: {mark}{_EOL}")
        .schema("value string")
        .text(path)
        .where(F.octet_length("value") > 0)
    )
    parts = lines.select(F.split("value", _GAP, 3).alias("p"))
    parts = parts.select(
        F.concat(F.lit(_EOL), F.col("p")[0], F.lit(_EOL)).alias("head"),
        F.col("p")[1].alias("http"),
        F.expr("left(p[2], char_length(p[2]) - 4)").alias("payload"),  # without the end of the record
    )

    def header(name: str) -> Column:
        return F.nullif(F.regexp_extract("head", rf"\r\n{name}: ([^\r]*)\r\n", 1), F.lit(""))

    def record(name: str) -> Column:
        return F.nullif(F.regexp_extract("head", rf"\r\n{name}: <urn:uuid:([^>\r]*)>", 1), F.lit(""))

    length = F.octet_length("http") + len(_GAP) + F.octet_length("payload")
    wrong = header("Content-Length").cast("long") != length
    return parts.select(
        F.when(wrong, F.raise_error(F.lit("record length differs from its header")))
        .otherwise(record("WARC-Record-ID"))
        .alias("record_id"),
        header("WARC-Type").alias("record_type"),
        header("X-Page-Id").cast("long").alias("page_id"),
        header("WARC-Target-URI").alias("url"),
        F.substring_index(header("WARC-Payload-Digest"), ":", -1).alias("payload_digest"),
        record("WARC-Refers-To").alias("refers_to_record"),
        header("X-Refers-To-Page-Id").cast("long").alias("refers_to"),
        "payload",
    )


def revisits(headers: DataFrame, min_bytes: int = 0) -> DataFrame:
    """(record_id, refers_to_record, refers_to) of records that repeat an earlier payload.

    Headers are shuffled by payload digest. Of equal payloads of at least `min_bytes` the record with the largest
    page id is the original (null ids are smallest, then the record id decides). Originals are counted before
    the shuffle and written, so that a digest that many records share is split in the join.
    """
    large = headers.where(F.col("payload_bytes") >= min_bytes)
    originals = (
        large.groupBy("payload_digest")
        .agg(F.max(F.struct("page_id", "record_id")).alias("first"), F.count(F.lit(1)).alias("n"))
        .where("n > 1")
        .select(
            "payload_digest",
            F.col("first.record_id").alias("refers_to_record"),
            F.col("first.page_id").alias("refers_to"),
        )
    )
    return (
        large.join(materialized(originals, "originals"), "payload_digest")
        .where(F.col("record_id") != F.col("refers_to_record"))
        .select("record_id", "refers_to_record", "refers_to")
    )


def deduplicate_archive(spark: SparkSession, path: str, mark: str, out: str, min_bytes: int = 0) -> str:
    """Writes the archive anew with revisit records for repeated payloads; returns the new mark."""
    records = read_archive(spark, path, mark)
    headers = materialized(
        records.select("record_id", "page_id", "payload_digest", F.octet_length("payload").alias("payload_bytes")),
        "headers",
    )
    found = materialized(revisits(headers, min_bytes), "revisits").withColumn("_revisit", F.lit(True))
    resolved = records.drop("refers_to_record", "refers_to").join(found, "record_id", "left")
    kind = F.when(F.col("_revisit"), "revisit").otherwise(F.col("record_type"))
    return write_archive(resolved.withColumn("record_type", kind), out)


def archive_digest(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Writes pages as an archive, deduplicates it, reads it back and resolves its revisits.

    One row per page: repeated rows (also of the same id) are records of their own; an empty table gives no rows.
    Digests of responses are computed from the payload that was read and compared with the header.
    """
    spark = pages.sparkSession
    raw, out = shared_dir(spark, "warc"), shared_dir(spark, "warc-deduplicated")
    mark = write_archive(page_records(pages.select("page_id", "url", "html")), raw)
    records = read_archive(spark, out, deduplicate_archive(spark, raw, mark, out, min_bytes))
    digest = base32_sha1(F.col("payload"))
    checked = F.when(
        (F.col("record_type") == "response") & (digest != F.col("payload_digest")),
        F.raise_error(F.lit("payload differs from its digest")),
    ).otherwise(F.col("payload_digest"))
    read = materialized(
        records.select(
            "record_id", "record_type", "page_id", checked.alias("payload_digest"), "refers_to_record", "refers_to",
            F.octet_length("payload").cast("long").alias("payload_bytes"),
        ),
        "records",
    )
    responses = read.where("record_type = 'response'")
    again = read.where("record_type = 'revisit'")
    originals = responses.select(
        F.col("record_id").alias("refers_to_record"), "payload_bytes", "payload_digest"
    )
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    resolved = again.drop("payload_bytes", "payload_digest").join(originals, "refers_to_record")
    return responses.select(columns).unionByName(resolved.select(columns))
