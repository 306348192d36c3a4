"""Content-addressed web archive.

Payload bytes are stored once under their SHA-256. Records keep their exact
header bytes apart from the payload and name it by digest; joining the two gives
the original records back, and every payload read is digested again. Two tables
make an archive: `payloads` (digest, payload) and `records` (head, digest, has_payload).

Of records with equal payloads of at least `least_bytes` bytes the first is the
response and the others are revisits that refer to it; smaller payloads are stored
once too, but their records are all responses.

Defined cases: a null page body is the empty payload; a null url leaves out the
target line, and line breaks in one are percent-encoded; a null page_id is
written as `none` and orders last; rows that repeat a page_id are records of
their own, the first stored of equal ones being the response; extra columns are
ignored; an empty table gives an empty archive.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarrylake.llm.common import release, stored
from quarrylake.session import scratch_path

BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"  # fixed value
END = "\r\n\r\n"
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"  # fixed value


@dataclass(frozen=True)
class Archive:
    """Where an archive's two tables are."""

    path: str

    def payloads(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema("digest binary, payload binary").parquet(f"{self.path}/payloads")

    def records(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema("head binary, digest binary, has_payload boolean").parquet(f"{self.path}/records")


def base32(hex_text: Column) -> Column:
    """Base32 of 40 hexadecimal digits: every five digits are four characters."""
    characters = []
    for group in range(8):
        bits = F.conv(F.substring(hex_text, 5 * group + 1, 5), 16, 10).cast("int")
        for shift in (15, 10, 5, 0):
            index = F.shiftright(bits, shift).bitwiseAND(F.lit(31))
            characters.append(F.substring(F.lit(BASE32), index + 1, F.lit(1)))
    return F.concat(*characters)


def payload_of(body: Column) -> Column:
    return F.coalesce(body, F.lit("")).cast("binary")


def digest_of(payload: Column) -> Column:
    return F.unhex(F.sha2(payload, 256))


def payload_store(payloads: DataFrame) -> DataFrame:
    """(digest, payload) once each. Equal digests of unequal payloads fail the job:
    a second, independent hash must agree within each digest."""
    second = F.xxhash64("payload")
    found = payloads.select(digest_of(F.col("payload")).alias("digest"), "payload", second.alias("again"))
    once = found.groupBy("digest").agg(F.first("payload").alias("payload"), F.min("again").alias("lo"), F.max("again").alias("hi"))
    sound = F.when(F.col("lo") == F.col("hi"), F.col("payload")).otherwise(F.raise_error(F.lit("two payloads with one digest")).cast("binary"))
    return once.select("digest", sound.alias("payload"))


def header(date: str) -> Column:
    """The exact bytes before the payload: record header, then the response's own header."""
    number = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("none"))
    name = lambda page, seq: F.concat(F.lit("<urn:page:"), number(page), F.lit(":"), F.col(seq).cast("string"), F.lit(">"))
    line = lambda key, value: F.concat(F.lit(f"{key}: "), value, F.lit("\r\n"))
    url = F.replace(F.replace(F.col("url"), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    inner = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("length").cast("string"), F.lit(END))
    block = F.octet_length(inner) + F.when(F.col("revisit"), 0).otherwise(F.col("length"))
    revisit = F.concat(line("WARC-Profile", F.lit(REVISIT)), line("WARC-Refers-To", name("first_id", "first_seq")))
    return F.concat(
        F.lit("WARC/1.1\r\n"),
        line("WARC-Type", F.when(F.col("revisit"), "revisit").otherwise("response")),
        line("WARC-Record-ID", name("page_id", "seq")),
        line("WARC-Date", F.lit(date)),
        F.coalesce(line("WARC-Target-URI", url), F.lit("")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("sha1"))),
        F.when(F.col("revisit"), revisit).otherwise(""),
        line("Content-Type", F.lit("application/http; msgtype=response")),
        F.lit("Content-Length: "), block.cast("string"), F.lit(END), inner,
    ).cast("binary")


def write_archive(pages: DataFrame, least_bytes: int = 0, date: str = "1970-01-01T00:00:00Z") -> Archive:
    """Archive (page_id, url, html) rows below a fresh path of the shared folder.

    Payloads cross a shuffle once, combined per task first; records only carry
    digests. Which record is the response is settled on stored row numbers.
    """
    spark = pages.sparkSession
    archive = Archive(scratch_path(spark, "archive"))
    bodies = pages.select("page_id", "url", payload_of(F.col("html")).alias("payload"))
    payload_store(bodies.select("payload")).write.option("compression", "zstd").parquet(f"{archive.path}/payloads")
    release(spark)
    rows = stored(bodies.select(
        "page_id", "url", F.monotonically_increasing_id().alias("seq"), digest_of(F.col("payload")).alias("digest"),
        base32(F.sha1("payload")).alias("sha1"), F.octet_length("payload").cast("long").alias("length"),
    ), "archive-rows")
    order = F.struct(F.col("page_id").isNull().alias("last"), "page_id", "seq")
    first = rows.groupBy("digest").agg(F.min(order).alias("first")).select("digest", F.col("first.page_id").alias("first_id"), F.col("first.seq").alias("first_seq"))
    known = rows.join(first, "digest").withColumn("revisit", (F.col("seq") != F.col("first_seq")) & (F.col("length") >= least_bytes))
    known.select(header(date).alias("head"), "digest", (~F.col("revisit")).alias("has_payload")).write.option("compression", "zstd").parquet(f"{archive.path}/records")
    return archive


def verified(payloads: DataFrame) -> DataFrame:
    """The payloads, each digested again; a difference fails the job."""
    sound = F.when(digest_of(F.col("payload")) == F.col("digest"), F.col("payload"))
    return payloads.select("digest", F.coalesce(sound, F.raise_error(F.lit("a payload differs from its digest")).cast("binary")).alias("payload"))


def restored(spark: SparkSession, archive: Archive) -> DataFrame:
    """(record, payload): every original record, byte for byte, and its full payload.

    A revisit's record ends after its headers; its payload is that of the response.
    """
    joined = archive.records(spark).join(verified(archive.payloads(spark)), "digest")
    body = F.when(F.col("has_payload"), F.col("payload")).otherwise(F.lit("").cast("binary"))
    return joined.select(F.concat("head", body, F.lit(END).cast("binary")).alias("record"), "payload")


def field(head: Column, name: str) -> Column:
    """The value of a header field, or null."""
    value = F.regexp_extract(head, rf"(?:^|\n){name}: ([^\r]*)\r\n", 1)
    return F.when(value != "", value)


def page_number(name: Column) -> Column:
    number = F.regexp_extract(name, r"^<urn:page:(-?\d+):", 1)
    return F.when(number != "", number).cast("long")


def read_archive(spark: SparkSession, archive: Archive) -> DataFrame:
    """Per record: page_id, url, record_type, refers_to, and length and SHA-1 of the
    stored payload, digested here; only digests cross the shuffle."""
    found = verified(archive.payloads(spark)).select("digest", F.octet_length("payload").cast("long").alias("payload_bytes"), base32(F.sha1("payload")).alias("payload_digest"))
    records = archive.records(spark).select(F.col("head").cast("string").alias("head"), "digest")
    fields = records.select(
        "digest",
        page_number(field(F.col("head"), "WARC-Record-ID")).alias("page_id"),
        field(F.col("head"), "WARC-Target-URI").alias("url"),
        field(F.col("head"), "WARC-Type").alias("record_type"),
        page_number(field(F.col("head"), "WARC-Refers-To")).alias("refers_to"),
    )
    return fields.join(found, "digest").select("page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to")
