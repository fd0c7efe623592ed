"""A content-addressed web archive: payloads once by digest, exact record headers apart, joined on reading."""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import stage

#: Fixed values of the format.
VERSION = "WARC/1.1"
CRLF = "\r\n"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


@dataclass(frozen=True)
class Archive:
    """`headers` (page_id, header, payload) and `payloads` (digest, payload); both lie in the shared folder."""

    headers: DataFrame
    payloads: DataFrame


def base32(hexadecimal: Column) -> Column:
    """Base32 of 20 bytes given in hexadecimal: every five digits are four letters."""
    five = F.transform(F.sequence(F.lit(0), F.lit(7)), lambda i: F.conv(F.substr(hexadecimal, i * 5 + 1, F.lit(5)), 16, 10).cast("int"))

    def letters(v):
        return F.concat(*[F.substr(F.lit(BASE32), F.shiftright(v, s).bitwiseAND(31) + 1, F.lit(1)) for s in (15, 10, 5, 0)])

    return F.array_join(F.transform(five, letters), "")


def field(name: str, value: Column) -> Column:
    """One header line, or nothing for a null value; line breaks in the value become spaces."""
    return F.when(value.isNull(), F.lit("")).otherwise(F.concat(F.lit(f"{name}: "), F.regexp_replace(value, "[\r\n]+", " "), F.lit(CRLF)))


def header_field(header: Column, name: str) -> Column:
    """The value of a header line, null if it is missing."""
    found = F.regexp_extract(header, f"\r\n{name}: ([^\r\n]*)", 1)
    return F.when(F.instr(header, f"\r\n{name}: ") > 0, found)


def write_archive(pages: DataFrame, date: str = "2024-01-01T00:00:00Z") -> Archive:
    """Write one record per row of `pages` (page_id, url, html); other columns are not read.

    The payload is the html in UTF-8, null as no bytes. Of equal payloads the smallest page_id is the
    response and the others are revisits that refer to it; rows that repeat that page_id are responses
    too, and the payload is still stored once. A null page_id is larger than any other.

    Equal payloads are found by SHA-256; SHA-1, MD5 and length of all rows of a digest must agree, or
    writing fails. Digests alone are grouped (partial aggregates, so a payload of a third of the rows
    does no harm); the bytes are shuffled once, spread by digest and page, to be stored.
    """
    raw = pages.select("page_id", "url", F.coalesce(F.col("html"), F.lit("")).cast("binary").alias("payload"))
    strong = F.unhex(F.sha2("payload", 256))
    meta = raw.select(
        "page_id", "url", strong.alias("digest"), F.sha1("payload").alias("sha1"), F.md5("payload").alias("md5"), F.octet_length("payload").cast("long").alias("size")
    )
    meta = stage(meta, "warc-meta")
    weak = F.concat_ws(":", "sha1", "md5", "size")
    owners = meta.groupBy("digest").agg(F.min("page_id").alias("owner"), F.min(weak).alias("least"), F.max(weak).alias("most"))
    differ = F.raise_error(F.lit("different payloads have one SHA-256 digest"))
    owners = owners.select("digest", F.when(F.col("least") == F.col("most"), F.col("owner")).otherwise(differ).alias("owner"))
    owners = stage(owners, "warc-owners")

    def place(page):  # never null, so that the join's partitioning also serves to drop repeated rows
        return F.coalesce(page.cast("string"), F.lit("")).alias("place")

    bodies = raw.select(strong.alias("digest"), place(F.col("page_id")), "payload")
    bodies = bodies.join(owners.select("digest", place(F.col("owner"))), ["digest", "place"])
    payloads = stage(bodies.dropDuplicates(["digest", "place"]).select("digest", "payload"), "warc-payloads")

    typed = meta.join(owners, "digest")
    response = F.col("page_id").eqNullSafe(F.col("owner"))
    name = F.md5(F.concat_ws("|", F.coalesce(F.col("page_id").cast("string"), F.lit("")), F.coalesce("url", F.lit(""))))
    uuid = F.concat_ws("-", *[F.substring(name, at, n) for at, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))])
    header = F.concat(
        F.lit(VERSION + CRLF),
        field("WARC-Type", F.when(response, F.lit("response")).otherwise(F.lit("revisit"))),
        field("WARC-Record-ID", F.concat(F.lit("<urn:uuid:"), uuid, F.lit(">"))),
        field("WARC-Date", F.lit(date)),
        field("WARC-Target-URI", F.col("url")),
        field("WARC-Payload-Digest", F.concat(F.lit("sha1:"), base32(F.col("sha1")))),
        field("WARC-Profile", F.when(~response, F.lit(REVISIT_PROFILE))),
        field("WARC-Refers-To-Page", F.when(~response, F.col("owner").cast("string"))),
        field("Content-Type", F.lit("text/html; charset=utf-8")),
        field("Content-Length", F.when(response, F.col("size")).otherwise(F.lit(0)).cast("string")),
        F.lit(CRLF),
    )
    headers = stage(typed.select("page_id", header.alias("header"), "digest"), "warc-headers")
    return Archive(headers, payloads)


def verified(archive: Archive) -> DataFrame:
    """(digest, payload) as stored; reading fails where the bytes no longer have their digest."""
    same = F.unhex(F.sha2("payload", 256)) == F.col("digest")
    broken = F.raise_error(F.lit("a stored payload does not have its digest"))
    return archive.payloads.select("digest", F.when(same, F.col("payload")).otherwise(broken).alias("payload"))


def records(archive: Archive) -> DataFrame:
    """(page_id, header, payload, record): the full payload of every record, and the record's exact bytes."""
    joined = archive.headers.join(verified(archive), "digest")
    block = F.when(header_field(F.col("header"), "WARC-Type") == "response", F.col("payload")).otherwise(F.lit("").cast("binary"))
    record = F.concat(F.col("header").cast("binary"), block, F.lit(CRLF * 2).cast("binary"))
    return joined.select("page_id", "header", "payload", record.alias("record"))


def read_back(archive: Archive) -> DataFrame:
    """What the archive holds per page: type, reference, and length and SHA-1 of the full payload.

    Lengths and digests are taken from the stored bytes, once per payload, and joined to the headers,
    so the bytes are not shuffled again. Reading fails where a header's digest differs from the bytes'.
    """
    facts = verified(archive).select(
        "digest", F.octet_length("payload").cast("long").alias("payload_bytes"), base32(F.sha1("payload")).alias("payload_digest")
    )
    joined = archive.headers.join(facts, "digest")
    header = F.col("header")
    same = header_field(header, "WARC-Payload-Digest") == F.concat(F.lit("sha1:"), F.col("payload_digest"))
    checked = F.when(same, F.col("payload_digest")).otherwise(F.raise_error(F.lit("a header's digest differs from its payload's")))
    return joined.select(
        "page_id",
        "payload_bytes",
        checked.alias("payload_digest"),
        header_field(header, "WARC-Type").alias("record_type"),
        header_field(header, "WARC-Refers-To-Page").cast(archive.headers.schema["page_id"].dataType).alias("refers_to"),
    )
