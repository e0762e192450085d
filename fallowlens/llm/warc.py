"""Content-addressed WARC archive: payload bytes once, record headers apart, joined again.

``write`` makes two tables: ``payloads`` holds each distinct payload under its SHA-256,
``headers`` the exact header bytes of every record with the digest of its payload.
``read`` verifies the stored payloads against their digests and joins the two back into
whole records. Only built-in functions are used.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fallowlens.llm.common import fresh_path, stored

#: WARC profile of a revisit with an equal payload (fixed value).
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Extension field with a URL's bytes as hex digits.
EXACT_URI = "X-Target-URI-Hex"
RFC4648 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
CONV32 = "0123456789ABCDEFGHIJKLMNOPQRSTUV"


@dataclass(frozen=True)
class Archive:
    payloads: str
    headers: str


def sha1_base32(payload: Column) -> Column:
    """Upper-case base32 of a binary column's SHA-1: 160 bits are four times 40 bits."""
    digest = F.sha1(payload)
    parts = [F.lpad(F.conv(F.substring(digest, 1 + 10 * i, 10), 16, 32), 8, "0") for i in range(4)]
    return F.translate(F.concat(*parts), CONV32, RFC4648)


def record_urn(page: Column, row: Column) -> Column:
    """A record's own name: the page and which of its repeated rows it is."""
    return F.concat(F.lit("<urn:page:"), F.coalesce(page.cast("string"), F.lit("")), F.lit(":"), row.cast("string"), F.lit(">"))


def header() -> Column:
    """Header text of a record with columns id, row, url, date, type, refers_to, first, sha1, bytes.

    ``row`` differs between all records, so that repeated rows have names of their own.
    The block is the page as the table has it, without the protocol's header.
    """
    line = lambda name, value: F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit("\r\n")), F.lit(""))
    revisit = F.col("type") == "revisit"
    only = lambda value: F.when(revisit, value)
    url = F.replace(F.replace(F.col("url"), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    legal = F.when(F.trim(url) == "", F.lit("urn:empty")).otherwise(F.trim(url))
    return F.concat(
        F.lit("WARC/1.1\r\n"),
        line("WARC-Type", F.col("type")),
        line("WARC-Record-ID", record_urn(F.col("id"), F.col("row"))),
        line("WARC-Date", F.col("date")),
        line("WARC-Target-URI", legal),
        # the URL itself where no header line can hold it
        line(EXACT_URI, F.when(legal != F.col("url"), F.hex(F.encode("url", "UTF-8")))),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("sha1"))),
        line("WARC-Profile", only(F.lit(PROFILE))),
        line("WARC-Refers-To", only(record_urn(F.col("refers_to"), F.col("first")))),
        line("Content-Type", F.lit("text/html; charset=utf-8")),
        line("Content-Length", F.when(revisit, F.lit("0")).otherwise(F.col("bytes").cast("string"))),
        F.lit("\r\n"),
    )


def header_field(name: str, text: Column | str = "header") -> Column:
    """A field of a header given as bytes; null if it is absent."""
    text = F.decode(F.col(text) if isinstance(text, str) else text, "UTF-8")
    found = F.regexp_extract(text, f"\r\n{name}: ([^\r\n]*)\r\n", 1)
    return F.when(found != "", found)


def records(
    pages: DataFrame, page_id: str, url: str, html: str, min_revisit_bytes: int = 0, date: str | None = None
) -> tuple[DataFrame, DataFrame]:
    """Payload rows (digest, payload) and header rows (digest, header) of the pages.

    Of records with equal payloads of at least ``min_revisit_bytes`` bytes the one with
    the largest id is the response, the others revisit it. Among repeated rows with that
    id, one is the response. Smaller payloads are responses all. ``date`` is when the pages
    were captured, by default the time of writing.
    """
    date = date or datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")
    payload = F.coalesce(F.encode(F.col(html), "UTF-8"), F.lit(b""))
    taken = pages.select(F.col(page_id).alias("id"), F.col(url).cast("string").alias("url"), payload.alias("payload"))
    digest = F.unhex(F.sha2("payload", 256)).alias("digest")
    light = stored(
        taken.select("id", "url", digest, sha1_base32(F.col("payload")).alias("sha1"),
                     F.octet_length("payload").cast("long").alias("bytes"), F.monotonically_increasing_id().alias("row")),
        "warc-rows",
    )
    best = (
        light.where(F.col("bytes") >= min_revisit_bytes)
        .groupBy("digest")
        .agg(F.max("id").alias("best"), F.count(F.lit(1)).alias("n"))
        .where("n > 1")
        .select("digest", "best")
    )
    first = (
        light.join(best, "digest").where(F.col("id").eqNullSafe(F.col("best")))
        .groupBy("digest", "best").agg(F.min("row").alias("first"))
        .select("digest", F.col("best").alias("refers_to"), "first")
    )
    typed = light.join(first, "digest", "left").withColumn("date", F.lit(date)).withColumn(
        "type", F.when(F.col("first") != F.col("row"), "revisit").otherwise("response")
    )
    heads = typed.select("digest", F.encode(header(), "UTF-8").alias("header"))
    payloads = taken.select(digest, "payload").groupBy("digest").agg(F.first("payload").alias("payload"))
    return payloads, heads


def write(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html",
          min_revisit_bytes: int = 0, folder: str | None = None, date: str | None = None) -> Archive:
    """Archive the pages below ``folder``, by default a new one in the shared folder."""
    spark = pages.sparkSession
    folder = folder or fresh_path(spark, "warc")
    payloads, heads = records(pages, page_id, url, html, min_revisit_bytes, date)
    archive = Archive(f"{folder}/payloads", f"{folder}/headers")
    payloads.write.parquet(archive.payloads)
    heads.write.parquet(archive.headers)
    return archive


def read(spark: SparkSession, archive: Archive) -> DataFrame:
    """Every record of an archive: ``header``, ``payload``, ``record`` and what verifying found.

    ``payload`` is the full payload, also of a revisit; ``record`` is the record as a
    WARC file has it, where a revisit has no block. ``payload_bytes`` and
    ``payload_digest`` are computed from the stored bytes. A payload that does not match
    its SHA-256, or a header that names another SHA-1, ends the job with an error.
    """
    stored_payloads = spark.read.parquet(archive.payloads)
    damaged = F.unhex(F.sha2("payload", 256)) != F.col("digest")
    verified = stored_payloads.select(
        F.when(damaged, F.raise_error(F.lit("payload does not match its digest"))).otherwise(F.col("digest")).alias("digest"),
        "payload",
        F.octet_length("payload").cast("long").alias("payload_bytes"),
        sha1_base32(F.col("payload")).alias("sha1"),
    )
    heads = spark.read.parquet(archive.headers)
    named = F.concat(F.lit("sha1:"), F.col("sha1")) == header_field("WARC-Payload-Digest")
    block = F.when(header_field("WARC-Type") == "revisit", F.lit(b"")).otherwise(F.col("payload"))
    return heads.join(verified, "digest").select(
        "header", "payload", F.concat("header", block, F.lit(b"\r\n\r\n")).alias("record"), "payload_bytes",
        F.when(named, F.col("sha1")).otherwise(F.raise_error(F.lit("header and payload differ"))).alias("payload_digest"),
    )


def page_records(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html",
                 min_revisit_bytes: int = 0) -> DataFrame:
    """Archive the pages, read the archive back, and describe each record by its header.

    One row per page: id, ``payload_bytes``, ``payload_digest``, ``record_type``,
    ``refers_to``, ``url``. A null html is the empty payload, which is shared like any
    other; a null url leaves its header out; a null id is smaller than any other. A
    group whose ids are all null has one response, to which its revisits name no id.
    Repeated rows are records each, under names of their own. URLs come back as they were,
    line breaks included, and payloads of any length as a whole. Other columns are left
    out; an empty table gives an empty archive.
    """
    found = read(pages.sparkSession, write(pages, page_id, url, html, min_revisit_bytes))
    number = lambda name: F.regexp_extract(header_field(name), "<urn:page:(.*):\\d+>", 1)
    as_id = lambda name: F.when(number(name) != "", number(name)).cast(pages.schema[page_id].dataType)
    return found.select(
        as_id("WARC-Record-ID").alias(page_id), "payload_bytes", "payload_digest",
        header_field("WARC-Type").alias("record_type"), as_id("WARC-Refers-To").alias("refers_to"),
        F.coalesce(F.decode(F.unhex(header_field(EXACT_URI)), "UTF-8"), F.when(
            header_field("WARC-Target-URI") == "urn:empty", F.lit("")).otherwise(header_field("WARC-Target-URI"))).alias("url"),
    )
