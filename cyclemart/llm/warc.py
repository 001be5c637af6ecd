"""Content-addressed WARC archive: payload bytes once, exact record headers apart.

An archive is two Parquet tables below one name:

* ``payloads``: each distinct payload once, addressed by its SHA-256, bucketed by it;
* ``records``: one row per page with the exact bytes of its WARC and HTTP headers.

The page with the smallest id of those with equal payloads is the ``response``; the others
are ``revisit`` records that refer to it, unless the payload is shorter than
``revisit_from`` bytes.  Reading back joins the headers of responses with their payload
(one to one, so no copy of a hot payload is made), checks both digests against the bytes,
and resolves revisits through the response they name.

Payloads are shuffled when equal ones are merged (each task first merges its own) and once
more to be stored in buckets of their digest, so reading back moves only headers.  A payload
that very many pages share is a hot key of the joins with what is known of it: those joins
split it in the plan (:mod:`cyclemart.operators.skew`).  Nothing is left in the catalog.

Defined cases: a NULL payload counts as empty; a NULL url leaves out the target header;
line breaks in a url are percent-encoded; rows that repeat the smallest page id of a
payload are all responses; a NULL page id is written as ``null`` and counts as the largest.
An empty table gives an empty archive.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cyclemart.llm.common import stored
from cyclemart.operators.skew import split_join
from cyclemart.session import scratch_path
from cyclemart.sources.bucketed import read_bucketed, write_bucketed

RESPONSE, REVISIT = "response", "revisit"
#: Base-32 digits as conv() writes them, and as RFC 4648 has them.
CONV_DIGITS, RFC_DIGITS = "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
#: The profile of revisits, the separator of header lines.
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
CRLF = "\r\n"


@dataclass(frozen=True)
class Archive:
    """The two tables of an archive."""

    payloads: DataFrame
    records: DataFrame


def base32_sha1(payload: Column) -> Column:
    """Upper-case base32 of the SHA-1: five hex digits are four base-32 digits."""
    hexed = F.sha1(payload)
    parts = [F.lpad(F.conv(F.substring(hexed, 5 * i + 1, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.concat(*parts), CONV_DIGITS, RFC_DIGITS)


def _page_uri(page_id: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(page_id.cast("string"), F.lit("null")), F.lit(">"))


def _headers() -> Column:
    """The exact header bytes of a record, up to where the payload begins."""
    def line(name: str, value: Column) -> Column:
        return F.when(value.isNotNull(), F.concat(F.lit(f"{name}: "), value, F.lit(CRLF))).otherwise("")

    response = F.col("record_type") == RESPONSE
    http = F.concat(
        F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "),
        F.col("payload_bytes").cast("string"), F.lit(CRLF + CRLF))
    url = F.replace(F.replace(F.col("url"), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    length = F.octet_length(http) + F.when(response, F.col("payload_bytes")).otherwise(0)
    return F.concat(
        F.lit(f"WARC/1.1{CRLF}WARC-Type: "), F.col("record_type"), F.lit(CRLF),
        line("WARC-Record-ID", _page_uri(F.col("page_id"))),
        line("WARC-Date", F.col("warc_date")),
        line("WARC-Target-URI", url),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("payload_digest"))),
        line("WARC-Refers-To", F.when(~response, _page_uri(F.col("refers_to")))),
        line("WARC-Profile", F.when(~response, F.lit(PROFILE))),
        line("Content-Type", F.lit("application/http;msgtype=response")),
        line("Content-Length", length.cast("string")),
        F.lit(CRLF), http,
    ).cast("binary")


def write_archive(
    pages: DataFrame, name: str | None = None, payload: str = "html", date: str = "2024-01-01T00:00:00Z",
    revisit_from: int = 0,
) -> Archive:
    """Write a record per row of ``pages`` (page_id, url, ``payload``) as archive ``name``."""
    spark = pages.sparkSession
    name = name or f"warc_{uuid.uuid4().hex[:12]}"
    body = F.coalesce(F.col(payload), F.lit("")).cast("binary")
    rows = pages.select("page_id", "url", body.alias("payload")).withColumn("sha256", F.sha2("payload", 256))
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = scratch_path(spark, f"{name}-payloads")
    once = (
        rows.groupBy("sha256")
        .agg(F.first("payload").alias("payload"), F.min("page_id").alias("first_page"))
        .withColumn("payload_bytes", F.octet_length("payload").cast("long"))
        .withColumn("payload_digest", base32_sha1(F.col("payload")))
    )
    write_bucketed(once, path, ["sha256"], buckets, compression="zstd")
    payloads = read_bucketed(spark, path, once.schema, ["sha256"], buckets)
    facts = spark.read.schema(once.schema).parquet(path).select("sha256", "first_page", "payload_bytes", "payload_digest")
    light = stored(rows.select("page_id", "url", "sha256"), f"{name}-pages")
    shared = (F.col("payload_bytes") >= revisit_from) & ~F.col("page_id").eqNullSafe(F.col("first_page"))
    records = (
        split_join(light, facts, ["sha256"])
        .withColumn("record_type", F.when(shared, REVISIT).otherwise(RESPONSE))
        .withColumn("refers_to", F.when(shared, F.col("first_page")))
        .withColumn("warc_date", F.lit(date))
        .select("page_id", "sha256", _headers().alias("headers"))
    )
    records = stored(records, f"{name}-records")
    return Archive(payloads, records)


def _header(name: str) -> Column:
    return F.regexp_extract(F.decode("headers", "UTF-8"), rf"(?s)^WARC/1\.1\r\n(?:.*?\r\n)?{name}: ([^\r]*)\r\n", 1)


def parsed_records(archive: Archive) -> DataFrame:
    """(page_id, sha256, headers, record_type, stored_digest, refers_to) from the headers."""
    def number(column: Column) -> Column:
        return F.regexp_extract(column, r"^<urn:page:(-?\d+)>$", 1).try_cast("long")

    return archive.records.select(
        number(_header("WARC-Record-ID")).alias("page_id"), "sha256", "headers",
        _header("WARC-Type").alias("record_type"),
        F.regexp_extract(_header("WARC-Payload-Digest"), "^sha1:(.*)$", 1).alias("stored_digest"),
        number(_header("WARC-Refers-To")).alias("refers_to"),
    )


def _intact() -> Column:
    """Whether both digests, taken anew from the bytes, are those stored."""
    return (F.sha2("payload", 256) == F.col("sha256")) & (base32_sha1(F.col("payload")) == F.col("stored_digest"))


def read_responses(archive: Archive) -> DataFrame:
    """Every response whole: its headers joined with its payload, ``record`` as in a file.

    ``intact`` says whether both digests, taken anew from the bytes, are those stored.
    """
    headers = parsed_records(archive).filter(F.col("record_type") == RESPONSE)
    bytes_ = archive.payloads.select("sha256", "payload")
    return split_join(headers, bytes_, ["sha256"]).select(
        "page_id", "record_type", "sha256", "payload",
        F.concat("headers", "payload", F.lit(CRLF + CRLF).cast("binary")).alias("record"), _intact().alias("intact"))


def read_payloads(archive: Archive) -> DataFrame:
    """Every original record with its full payload: the join that undoes the addressing.

    Copies of a payload are made here, as the originals had them; a payload with very many
    records is split over tasks.
    """
    return split_join(parsed_records(archive), archive.payloads.select("sha256", "payload"), ["sha256"])


def read_summary(archive: Archive) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) from the bytes.

    Lengths and digests come from the payloads, checked against the headers of a response; a
    revisit takes those of the payload it shares.  A damaged payload raises.
    """
    records = parsed_records(archive)
    stored_ = records.filter(F.col("record_type") == RESPONSE).groupBy("sha256").agg(F.max("stored_digest").alias("stored_digest"))
    checked = F.when(_intact(), F.octet_length("payload").cast("long")).otherwise(
        F.raise_error(F.concat(F.lit("damaged payload "), F.col("sha256"))).cast("long"))
    facts = archive.payloads.select("sha256", "payload").join(stored_, "sha256").select(
        "sha256", checked.alias("payload_bytes"), base32_sha1(F.col("payload")).alias("payload_digest"))
    light = records.select("page_id", "sha256", "record_type", "refers_to")
    return split_join(light, facts, ["sha256"]).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
