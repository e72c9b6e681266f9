"""Scalar expressions. All are built from Spark functions, so Catalyst sees through them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def falsy(df: DataFrame, name: str) -> Column:
    """Whether a column counts as missing: absent, null, empty, zero or false. NaN counts as a value."""
    if name not in df.columns:
        return F.lit(True)
    col, kind = F.col(f"`{name}`"), df.schema[name].dataType
    if isinstance(kind, T.NumericType):
        blank = col == 0
    elif isinstance(kind, T.BooleanType):
        blank = ~col
    elif isinstance(kind, T.StringType):
        blank = col == ""
    elif isinstance(kind, T.BinaryType):
        blank = F.length(col) == 0
    elif isinstance(kind, (T.ArrayType, T.MapType)):
        blank = F.size(col) == 0
    else:
        blank = F.lit(False)
    return col.isNull() | F.coalesce(blank, F.lit(False))


def first_truthy(df: DataFrame, names: Sequence[str]) -> Column:
    """The first column that isn't falsy, else null; as text if the columns' types differ."""
    there = [n for n in names if n in df.columns]
    as_text = len({df.schema[n].dataType for n in there}) > 1
    picks = [F.when(~falsy(df, n), F.col(f"`{n}`").cast("string") if as_text else F.col(f"`{n}`")) for n in there]
    return F.coalesce(*picks) if picks else F.lit(None).cast("string")


def text_or(col: Column, default: Column) -> Column:
    """``col``, or ``default`` where it is null or empty."""
    return F.coalesce(F.nullif(col, F.lit("")), default)


def is_yes(col: Column) -> Column:
    return col.eqNullSafe(F.lit("Y"))


def hours_before(as_of: Column, hours: int) -> Column:
    return as_of - F.make_interval(hours=F.lit(hours))


def recent(ts: Column, as_of: Column, hours: int) -> Column:
    """On the day of ``as_of`` and at most ``hours`` before it."""
    return (F.to_date(ts) == F.to_date(as_of)) & (ts >= hours_before(as_of, hours))


def minutes_between(later: Column, earlier: Column) -> Column:
    """Minute boundaries crossed, not whole minutes elapsed."""
    start, end = F.date_trunc("minute", earlier), F.date_trunc("minute", later)
    return F.timestamp_diff("MINUTE", start, end)


def batch_label(ts: Column) -> Column:
    return F.date_format(ts, "yyyyMMdd")


def last_segment(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def object_name(uri: Column) -> Column:
    """The qualified name of an object-store URI: bucket and path are parted by a dot."""
    bucket, rest = F.regexp_extract(uri, "^s3://([^/]+)/(.+)$", 1), F.regexp_extract(uri, "^s3://([^/]+)/(.+)$", 2)
    named = F.when(F.coalesce(uri, F.lit("")) == "", "s3:unknown").when(bucket != "", F.concat(F.lit("s3:"), bucket, F.lit("."), F.trim(rest)))
    return named.when(uri.startswith("s3://"), F.concat(F.lit("s3:"), F.substring(uri, 6, 1 << 20))).otherwise(F.concat(F.lit("s3:"), uri))


def parsed_json(value: Column, schema: str) -> Column:
    """The fields of a JSON object, null for anything malformed."""
    return F.from_json(value.cast("string"), schema, {"mode": "PERMISSIVE"})


def record_hash(df: DataFrame, fields: Sequence[str], digest: str = "sha256") -> Column:
    """Hex digest of the fields in name order, each as text and a bar: '' for an absent column, ``None`` for null."""
    pieces = []
    for name in sorted(fields):
        if name in df.columns:
            text = F.col(f"`{name}`").cast("string")
            text = F.initcap(text) if isinstance(df.schema[name].dataType, T.BooleanType) else text
            pieces.append(F.coalesce(text, F.lit("None")))
        else:
            pieces.append(F.lit(""))
        pieces.append(F.lit("|"))
    joined = F.concat(*pieces)
    if digest == "md5":
        return F.md5(joined)
    if digest == "sha1":
        return F.sha1(joined)
    return F.sha2(joined, {"sha224": 224, "sha256": 256, "sha384": 384, "sha512": 512}[digest])


def freshness_label(minutes: Column, warn: int = 60, alert: int = 120, no_data: str = "OK") -> Column:
    """Fixed labels; a table without rows gets ``no_data``."""
    return F.when(minutes.isNull(), no_data).when(minutes > alert, "ALERT: Data stale").when(minutes > warn, "WARNING: Check pipeline").otherwise("OK")


def overall_status(report: Column) -> Column:
    return F.when(report.contains("ALERT"), "CRITICAL").when(report.contains("WARNING"), "WARNING").otherwise("HEALTHY")


def volume_label(count: Column, least: int = 1000) -> Column:
    return F.when(count < least, "WARNING: Low record count").otherwise("OK")
