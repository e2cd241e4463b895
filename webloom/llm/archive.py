"""Content-addressed web archive: payload bytes once by digest, record headers on their own."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from webloom.llm.common import join_counted, shared_table

# Digits of base32 in the order of their values (fixed value).
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
# The profile of a record that repeats another one's payload (fixed value).
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
NEW_LINE = "\r\n"
# Payloads of at least so many bytes are revisited; smaller ones are stored as responses.
LEAST_BYTES = 0


@dataclass(frozen=True)
class Archive:
    """``records``: ``(page_id, header, digest)``, one row for each record; ``payloads``: ``(digest,
    payload, n)``, one for each different payload, with the number of its records."""

    records: DataFrame
    payloads: DataFrame


def base32(hex40: Column) -> Column:
    """Base32 of a SHA-1 given in hex digits: eight times five hex digits make four base32 digits."""
    pieces = []
    for k in range(8):
        number = F.conv(F.substring(hex40, 5 * k + 1, 5), 16, 10).cast("int")
        for shift in (15, 10, 5, 0):
            digit = F.shiftright(number, shift).bitwiseAND(F.lit(31))
            pieces.append(F.substring(F.lit(BASE32), digit + 1, F.lit(1)))
    return F.concat(*pieces)


def payload_of(html: Column) -> Column:
    """The bytes of a page: UTF-8, empty for null."""
    return F.coalesce(html, F.lit("")).cast("binary")


def header_text(least_bytes: int = LEAST_BYTES) -> Column:
    """The header block of a record, as it stands in a WARC file, without the empty line after it."""
    revisit = (F.col("page_id") < F.col("response_id")) & (F.col("bytes") >= F.lit(least_bytes))
    kind = F.when(revisit, "revisit").otherwise("response")

    def line(name: str, value: Column) -> Column:
        return F.concat(F.lit(f"{name}: "), value, F.lit(NEW_LINE))

    # A line break in an address would end the header line; a null address has no line.
    address = F.regexp_replace(F.col("url"), r"[\r\n]", "")
    page = F.coalesce(F.col("page_id").cast("string"), F.lit(""))
    return F.concat(
        F.lit(f"WARC/1.1{NEW_LINE}"),
        line("WARC-Type", kind),
        line("WARC-Record-ID", F.concat(F.lit("<urn:page:"), page, F.lit(">"))),
        F.coalesce(line("WARC-Target-URI", address), F.lit("")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("sha1"))),
        F.when(revisit, line("WARC-Profile", F.lit(REVISIT_PROFILE))).otherwise(""),
        F.when(
            revisit,
            line("WARC-Refers-To", F.concat(F.lit("<urn:page:"), F.col("response_id").cast("string"), F.lit(">"))),
        ).otherwise(""),
        line("Content-Type", F.lit("text/html")),
        line("Content-Length", F.when(revisit, F.lit(0)).otherwise(F.col("bytes")).cast("string")),
    )


def build(pages: DataFrame, least_bytes: int = LEAST_BYTES) -> Archive:
    """Archive of ``pages`` (page_id, url, html): every row becomes a record, every different payload
    is stored once. Among records of one payload that with the largest ``page_id`` is the response
    and the others revisit it; rows that repeat that id, and rows without an id, are responses too.

    Payloads are told apart by SHA-256. Only digests are grouped; the bytes of the rows that are
    kept move once, to be stored. Many rows with one payload are joined to it without a shuffle.
    """
    payload = payload_of(F.col("html"))
    slim = shared_table(
        pages.select(
            "page_id",
            "url",
            F.sha2(payload, 256).alias("digest"),
            base32(F.sha1(payload)).alias("sha1"),
            F.octet_length(payload).cast("bigint").alias("bytes"),
        )
    )
    owners = shared_table(
        slim.groupBy("digest").agg(F.max("page_id").alias("response_id"), F.count(F.lit(1)).alias("n"))
    )
    headed = join_counted(slim, owners, "digest", slim.count())
    records = headed.select("page_id", header_text(least_bytes).alias("header"), "digest")

    keep = owners.where(F.col("response_id").isNotNull()).select(
        F.col("response_id").alias("page_id"), "digest", "n"
    )
    bodies = pages.select("page_id", payload.alias("payload")).withColumn("digest", F.sha2("payload", 256))
    # Rows that repeat an id and a payload lie together after the join, so this takes no shuffle.
    stored = bodies.join(keep, ["page_id", "digest"]).dropDuplicates(["page_id", "digest"])
    # Payloads that only rows without an id have.
    nameless = owners.where(F.col("response_id").isNull()).select("digest", "n")
    rest = bodies.where(F.col("page_id").isNull()).dropDuplicates(["digest"]).join(nameless, "digest")
    payloads = stored.unionByName(rest).select("digest", "payload", "n")
    return Archive(records, payloads)


def write(archive: Archive, path: str) -> None:
    archive.records.write.parquet(f"{path}/records")
    archive.payloads.write.parquet(f"{path}/payloads")


def read(spark: SparkSession, path: str) -> Archive:
    """The archive below ``path``."""
    return Archive(spark.read.parquet(f"{path}/records"), spark.read.parquet(f"{path}/payloads"))


def stored_once(archive: Archive) -> Archive:
    """The archive written to the shared folder and read back."""
    return Archive(shared_table(archive.records), shared_table(archive.payloads))


def header_field(name: str) -> Column:
    """The value of a header line, null without one."""
    found = F.regexp_extract("header", rf"(?:^|\n){name}: ([^\r\n]*)", 1)
    return F.nullif(found, F.lit(""))


def record_index(archive: Archive) -> DataFrame:
    """``(page_id, payload_bytes, payload_digest, record_type, refers_to)`` from the stored headers
    and payloads. Every payload's bytes are hashed again; a payload that does not fit its digest
    stops the job, as does a record whose SHA-1 is not that of its payload."""
    checked = archive.payloads.select(
        "digest",
        "n",
        F.octet_length("payload").cast("bigint").alias("payload_bytes"),
        base32(F.sha1("payload")).alias("stored_sha1"),
        (F.sha2("payload", 256) == F.col("digest")).alias("fits"),
    )
    joined = join_counted(archive.records, shared_table(checked), "digest", archive.records.count())
    sha1 = F.regexp_replace(header_field("WARC-Payload-Digest"), "^sha1:", "")
    verified = F.col("fits") & (sha1 == F.col("stored_sha1"))
    wrong = F.raise_error(F.concat(F.lit("payload does not match its digest "), F.col("digest")))
    return joined.select(
        "page_id",
        F.when(verified, F.col("payload_bytes")).otherwise(wrong.cast("bigint")).alias("payload_bytes"),
        sha1.alias("payload_digest"),
        header_field("WARC-Type").alias("record_type"),
        F.regexp_extract(header_field("WARC-Refers-To"), r"<urn:page:(-?\d+)>", 1).cast("bigint").alias("refers_to"),
    )


def reconstruct(archive: Archive) -> DataFrame:
    """``(page_id, record)``: the bytes of each record of a WARC file, header, empty line, payload and
    two line ends, with the payload joined from the store. A revisit has no payload of its own."""
    joined = join_counted(archive.records, archive.payloads, "digest", archive.records.count())
    own = F.when(header_field("WARC-Type") == "response", F.col("payload")).otherwise(F.lit(b""))
    ends = F.lit(NEW_LINE).cast("binary")
    return joined.select(
        "page_id", F.concat(F.col("header").cast("binary"), ends, own, ends, ends).alias("record")
    )


def restore_pages(archive: Archive) -> DataFrame:
    """``(page_id, url, html)`` as archived, but for null pages, which come back empty."""
    joined = join_counted(archive.records, archive.payloads, "digest", archive.records.count())
    return joined.select(
        "page_id",
        header_field("WARC-Target-URI").alias("url"),
        F.decode("payload", "UTF-8").alias("html"),
    )
