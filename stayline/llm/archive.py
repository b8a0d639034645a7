"""Content-addressed web archive: payload bytes once, record headers exact, records rebuilt by joins.

An archive is a folder of two tables.  ``payloads`` holds each distinct payload once
under its SHA-256, with its SHA-1 and length.  ``records`` holds for every capture
the exact header bytes of its WARC record and the digest of its payload.  Of the
captures with equal payloads (of ``revisit_from`` bytes or more) the one with the
largest page id is a response, the others are revisits that refer to it.

Payloads meet under their digest with a map-side combine, so a payload that a third
of the pages share leaves each task once.  Digests are verified twice: captures
under one SHA-256 must agree in length and SHA-1 when they are stored, and stored
bytes must hash to their key when they are read.

Cases: null html is an empty payload; null url and null page id leave their header
fields empty; of rows with the same id and payload one is the response, the others
revisit it; an empty table gives an empty archive; other columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stayline.staging import new_path, stage

CRLF = "\r\n"
CAPTURED_AT = "2024-01-01T00:00:00Z"
#: The digits of conv() and the base32 alphabet of RFC 4648.
CONV_DIGITS, BASE32 = "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


@dataclass(frozen=True)
class Archive:
    path: str

    @property
    def payloads(self) -> str:
        return f"{self.path}/payloads"

    @property
    def records(self) -> str:
        return f"{self.path}/records"


def base32_sha1(payload: Column) -> Column:
    """Upper-case base32 of the SHA-1: 160 bits are four groups of forty, eight digits each."""
    digest = F.sha1(payload)
    groups = [F.lpad(F.conv(F.substring(digest, 10 * i + 1, 10), 16, 32), 8, "0") for i in range(4)]
    return F.translate(F.concat(*groups), CONV_DIGITS, BASE32)


def _payload(html: str) -> Column:
    return F.encode(F.coalesce(F.col(html), F.lit("")), "UTF-8")


def _http_header(length: Column) -> Column:
    lines = ["HTTP/1.1 200 OK", "Content-Type: text/html; charset=utf-8", "Content-Length: "]
    return F.concat(F.lit(CRLF.join(lines)), length, F.lit(CRLF * 2))


def _warc_header(record: dict[str, Column]) -> Column:
    fields = [F.concat(F.lit(f"{name}: "), F.coalesce(value.cast("string"), F.lit(""))) for name, value in record.items()]
    return F.concat(F.concat_ws(CRLF, F.lit("WARC/1.1"), *fields), F.lit(CRLF * 2))


def write_archive(
    pages: DataFrame, path: str, key: str = "page_id", url: str = "url", html: str = "html", revisit_from: int = 0
) -> Archive:
    """Write the two tables under ``path``."""
    archive = Archive(path)
    rows = pages.select(F.col(key).alias("page_id"), F.col(url).alias("url"), _payload(html).alias("payload"))
    rows = rows.withColumn("digest", F.unhex(F.sha2("payload", 256)))
    facts = [F.octet_length("payload").cast("long").alias("payload_bytes"), base32_sha1(F.col("payload")).alias("sha1")]
    stored = rows.groupBy("digest").agg(F.any_value("payload").alias("payload")).select("digest", "payload", *facts)
    stored.write.option("compression", "zstd").parquet(archive.payloads)

    captures = stage(rows.select(F.monotonically_increasing_id().alias("row"), "page_id", "url", "digest", *facts))
    groups = captures.groupBy("digest").agg(
        F.max(F.struct("page_id", "row")).alias("first"),
        F.assert_true(
            (F.min("payload_bytes") == F.max("payload_bytes")) & (F.min("sha1") == F.max("sha1")),
            "two payloads share a SHA-256",
        ).alias("verified"),
    )
    joined = captures.join(groups.where("verified IS NULL").select("digest", "first"), "digest")
    response = (F.col("payload_bytes") < revisit_from) | (F.col("first.row") == F.col("row"))
    named = lambda row: F.concat(F.lit("<urn:capture:"), row, F.lit(">"))
    http = _http_header(F.col("payload_bytes"))
    length = F.octet_length(http) + F.when(response, F.col("payload_bytes")).otherwise(0)
    shared = {
        "WARC-Record-ID": named(F.col("row")),
        "WARC-Date": F.lit(CAPTURED_AT),
        "WARC-Target-URI": F.regexp_replace("url", r"[\r\n]", ""),
        "WARC-Payload-Digest": F.concat(F.lit("sha1:"), "sha1"),
        "Content-Type": F.lit("application/http;msgtype=response"),
        "Content-Length": length,
    }
    back = {
        "WARC-Profile": F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
        "WARC-Refers-To": named(F.col("first.row")),
        "X-Refers-To-Page": F.col("first.page_id"),
    }
    header = F.when(response, _warc_header({"WARC-Type": F.lit("response"), **shared})).otherwise(
        _warc_header({"WARC-Type": F.lit("revisit"), **shared, **back})
    )
    records = joined.select("page_id", "digest", F.encode(F.concat(header, http), "UTF-8").alias("header"))
    records.write.option("compression", "zstd").parquet(archive.records)
    return archive


def read_payloads(spark: SparkSession, archive: Archive) -> DataFrame:
    """The stored payloads; bytes that do not hash to their key end the job."""
    table = spark.read.parquet(archive.payloads)
    sound = F.unhex(F.sha2("payload", 256)) == F.col("digest")
    checked = F.when(sound, F.col("payload")).otherwise(F.raise_error(F.lit("a stored payload does not match its digest")))
    return table.withColumn("payload", checked)


def _field(name: str) -> Column:
    return F.regexp_extract(F.decode("header", "UTF-8"), rf"\r\n{name}: ([^\r\n]*)", 1)


def read_records(spark: SparkSession, archive: Archive) -> DataFrame:
    """Every record as its header and its payload tell: (page_id, payload_bytes, payload_digest, record_type, refers_to).

    Bytes and digest are taken from the stored payload, once per payload, and must
    equal what the header says.
    """
    stored = read_payloads(spark, archive).select(
        "digest", F.octet_length("payload").cast("long").alias("payload_bytes"), base32_sha1(F.col("payload")).alias("payload_digest")
    )
    records = spark.read.parquet(archive.records).select(
        "page_id",
        "digest",
        F.substring_index(_field("WARC-Payload-Digest"), ":", -1).alias("told"),
        _field("WARC-Type").alias("record_type"),
        F.nullif(_field("X-Refers-To-Page"), F.lit("")).cast("long").alias("refers_to"),
    )
    agreed = F.when(F.col("told") == F.col("payload_digest"), F.col("payload_digest")).otherwise(
        F.raise_error(F.lit("a record's header and its payload disagree"))
    )
    return records.join(stored, "digest").select(
        "page_id", "payload_bytes", agreed.alias("payload_digest"), "record_type", "refers_to"
    )


def restore_records(spark: SparkSession, archive: Archive) -> DataFrame:
    """The original WARC records, (page_id, record): header, payload for responses, closing line feeds."""
    records = spark.read.parquet(archive.records)
    joined = records.join(read_payloads(spark, archive).select("digest", "payload"), "digest")
    body = F.when(_field("WARC-Type") == "response", F.col("payload")).otherwise(F.lit(b""))
    return joined.select("page_id", F.concat("header", body, F.lit(b"\r\n\r\n")).alias("record"))


def restore_captures(spark: SparkSession, archive: Archive) -> DataFrame:
    """Every capture with its full payload, revisits included: (page_id, url, payload)."""
    records = spark.read.parquet(archive.records)
    joined = records.join(read_payloads(spark, archive).select("digest", "payload"), "digest")
    return joined.select("page_id", _field("WARC-Target-URI").alias("url"), "payload")


def new_archive_path(spark: SparkSession) -> str:
    """A folder that goes with the current run."""
    return new_path(spark)
