"""A content-addressed WARC archive: payloads once by digest, exact record headers beside them.

``write`` puts a table into two Parquet tables in the shared folder. ``payloads`` holds each distinct payload once
under its SHA-256; ``headers`` holds the header block of every record, byte for byte, with the digest of its payload.
``read`` joins them again: the payload is checked against its digest, and what the record says is parsed from its
header block. ``record_bytes`` gives the standard record (header block, empty line, block, two line ends).

Of records with equal payloads of at least ``min_bytes`` bytes, the one with the smallest page_id is the response and
the others are revisits that refer to it; records with smaller payloads are all responses.

Header lines end in CR LF alone, whatever other line separators a url holds. A url with CR or LF is stored with these
and ``%`` percent-encoded, under a field of ours that says so, and comes back as it was; so are ids that are strings.

Nulls: a null payload is empty, a null url an empty target; a null id has a record id without a last part. Rows with a null page_id are archived like others and
never are a revisit's response unless no other row has the payload; then refers_to is null too. Repeated page_ids with
equal payloads are responses alike.
"""

from __future__ import annotations

import dataclasses
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from loomwork.llm._common import renamed, written

DIGITS, BASE32 = "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
END = "\r\n"


@dataclasses.dataclass(frozen=True)
class Archive:
    """``headers`` (digest, header) and ``payloads`` (digest, payload)."""

    headers: DataFrame
    payloads: DataFrame


def base32_sha1(data: Column) -> Column:
    """The bare upper-case base32 SHA-1: 160 bits are eight groups of five hex digits, four base32 digits each."""
    digest = F.sha1(data)
    groups = [F.lpad(F.conv(F.substring(digest, 5 * i + 1, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.concat(*groups), DIGITS, BASE32)


def write(pages: DataFrame, min_bytes: int = 0, date: str = "1970-01-01T00:00:00Z", id_col: str = "page_id", url_col: str = "url", payload_col: str = "html") -> Archive:
    """Archive ``pages`` and return the two tables as read back."""
    kind = pages.schema[id_col].dataType
    rows = renamed(pages, page_id=id_col, url=url_col, payload=payload_col)
    rows = rows.select("page_id", F.coalesce("url", F.lit("")).alias("url"), F.coalesce(F.col("payload").cast("binary"), F.lit(b"")).alias("payload"))
    rows = rows.withColumn("digest", F.sha2("payload", 256))

    firsts = rows.groupBy("digest").agg(F.min("page_id").alias("first_id"))
    small = rows.select("page_id", "url", "digest", F.octet_length("payload").cast("long").alias("bytes"), base32_sha1(F.col("payload")).alias("sha1"))
    records = small.join(firsts, "digest")
    again = (F.col("bytes") >= min_bytes) & ~F.col("page_id").eqNullSafe(F.col("first_id"))
    kept = F.when(again, "revisit").otherwise("response")
    several = F.contains("url", F.lit("\r")) | F.contains("url", F.lit("\n"))
    target = F.when(several, _encoded(F.col("url"))).otherwise(F.col("url"))
    plain = lambda c: _encoded(c) if isinstance(kind, StringType) else c.cast("string")
    urn = lambda c: F.when(c.isNull(), "<urn:page>").otherwise(F.concat(F.lit("<urn:page:"), plain(c), F.lit(">")))
    fields = [
        F.lit("WARC/1.1"),
        F.concat(F.lit("WARC-Type: "), kept),
        F.concat(F.lit("WARC-Record-ID: "), urn(F.col("page_id"))),
        F.lit(f"WARC-Date: {date}"),
        F.concat(F.lit("WARC-Target-URI: "), target),
        F.when(several, F.lit("X-Target-URI-Encoding: percent")),
        F.concat(F.lit("WARC-Payload-Digest: sha1:"), F.col("sha1")),
        F.when(again, F.concat(F.lit("WARC-Refers-To: "), urn(F.col("first_id")))),
        F.when(again, F.lit("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")),
        F.lit("Content-Type: text/html"),
        F.concat(F.lit("Content-Length: "), F.when(again, F.lit("0")).otherwise(F.col("bytes").cast("string"))),
    ]
    headers = records.select("digest", F.concat(F.concat_ws(END, *fields), F.lit(END)).alias("header"))
    # each task drops its own copies before any payload is dealt out, so a common payload isn't a hot key
    payloads = rows.groupBy("digest").agg(F.any_value("payload").alias("payload"))
    return Archive(written(headers, "warc-headers"), written(payloads, "warc-payloads"))


def _field(name: str) -> Column:
    """A field's value; empty if the header has no such field."""
    return F.regexp_extract("header", rf"(?:^|\r\n){name}: ([^\r\n]*)", 1)


#: What is encoded: a percent sign first, and decoded last.
ENCODED = (("%", "%25"), ("\r", "%0D"), ("\n", "%0A"))


def _encoded(text: Column) -> Column:
    return reduce(lambda c, pair: F.replace(c, *map(F.lit, pair)), ENCODED, text)


def _decoded(text: Column) -> Column:
    return reduce(lambda c, pair: F.replace(c, F.lit(pair[1]), F.lit(pair[0])), ENCODED[::-1], text)


def read(archive: Archive, id_type: str = "long") -> DataFrame:
    """(page_id, url, record_type, refers_to, payload_digest, header, payload, payload_bytes, stored_digest) of each
    record, reconstructed from both tables. ``payload_bytes`` and ``stored_digest`` are of the payload as stored, and
    are computed beside it, so that a reader who asks for no payload deals none out. A payload that doesn't match its
    digest raises."""
    sound = F.col("digest") == F.sha2("payload", 256)
    payloads = archive.payloads.select(
        F.when(sound, F.col("digest")).otherwise(F.raise_error(F.concat(F.lit("payload doesn't match its digest: "), "digest"))).alias("digest"),
        "payload",
        F.octet_length("payload").cast("long").alias("payload_bytes"),
        base32_sha1(F.col("payload")).alias("stored_digest"),
    )

    def page(urn: Column) -> Column:
        text = F.when(urn.startswith("<urn:page:"), F.regexp_extract(urn, "(?s)^<urn:page:(.*)>$", 1))
        return (_decoded(text) if id_type == "string" else text).cast(id_type)

    stored_url = _field("WARC-Target-URI")
    records = archive.headers.select(
        "digest",
        "header",
        page(_field("WARC-Record-ID")).alias("page_id"),
        F.when(_field("X-Target-URI-Encoding") == "percent", _decoded(stored_url)).otherwise(stored_url).alias("url"),
        _field("WARC-Type").alias("record_type"),
        page(_field("WARC-Refers-To")).alias("refers_to"),
        F.regexp_replace(_field("WARC-Payload-Digest"), "^sha1:", "").alias("payload_digest"),
    )
    return records.join(payloads, "digest").select("page_id", "url", "record_type", "refers_to", "payload_digest", "header", "payload", "payload_bytes", "stored_digest")


def record_of() -> Column:
    """The record as it stands in a WARC file, from the columns of ``read``; a revisit has an empty block."""
    block = F.when(F.col("record_type") == "response", F.col("payload")).otherwise(F.lit(b""))
    return F.concat(F.col("header").cast("binary"), F.lit(END.encode()), block, F.lit((END * 2).encode()))


def record_bytes(records: DataFrame) -> DataFrame:
    """(page_id, record) of each record."""
    return records.select("page_id", record_of().alias("record"))
