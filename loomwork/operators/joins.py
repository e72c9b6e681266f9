"""Lookups, reconciliation and change detection. Spark picks the join strategy; nothing is broadcast by hand."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomwork.functions.scalars import batch_label, falsy, is_yes, record_hash, text_or


def latest_per_key(df: DataFrame, keys: Sequence[str], *order: Column) -> DataFrame:
    """One row a key, first in ``order``."""
    n = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_n", n).where("_n = 1").drop("_n")


def one_per_key(df: DataFrame, key: str) -> DataFrame:
    """``df``, whose keys must have one row each: a second row raises when the rows are read. Null keys may repeat."""
    n = F.count("*").over(Window.partitionBy(key))
    several = F.raise_error(F.concat(F.lit(f"more than one row for {key} "), F.col(key).cast("string")))
    checked = df.withColumn("_n", F.when((n > 1) & F.col(key).isNotNull(), several).otherwise(F.lit(True)))
    return checked.where("_n is null or _n").drop("_n")


def upserted(old: DataFrame, new: DataFrame, key: str, *order: Column) -> DataFrame:
    """Old and new rows with one row a key: the first in ``order``, new ones before old on a tie."""
    both = old.withColumn("_new", F.lit(0)).unionByName(new.withColumn("_new", F.lit(1)), allowMissingColumns=True)
    return latest_per_key(both, [key], *order, F.desc("_new")).drop("_new")


def lookup_fallback(new: DataFrame, existing: DataFrame, columns: list[tuple[str, str]], key: Column, existing_key: str, newest: Sequence[Column], by: str = "in_col", metadata: Sequence[Column] = ()) -> DataFrame:
    """The mapped columns of every new row, each taken from the latest existing row of its key where null. ``by`` names
    the existing column to read: the mapping's input (``in_col``) or output (``out_col``). Adds ``_metadata`` with
    ``enriched``: whether the key was found. A null key finds nothing."""
    wanted = {(i if by == "in_col" else o) for o, i in columns} & set(existing.columns)
    slim = existing.where(F.col(existing_key).isNotNull())
    slim = latest_per_key(slim, [existing_key], *newest).select(F.col(existing_key).alias("_key"), F.lit(True).alias("_found"), *[F.col(f"`{c}`").alias(f"_old_{c}") for c in sorted(wanted)])
    joined = new.withColumn("_new_key", key.cast(slim.schema["_key"].dataType)).join(slim, F.col("_new_key") == F.col("_key"), "left")
    out = []
    for o, i in columns:
        old = i if by == "in_col" else o
        choices = ([F.col(f"`{i}`")] if i in new.columns else []) + ([F.col(f"`_old_{old}`")] if old in wanted else [])
        out.append((F.coalesce(*choices) if choices else F.lit(None).cast("string")).alias(o))
    found = F.coalesce("_found", F.lit(False)).alias("enriched")
    return joined.select(*out, F.struct(*metadata, found).alias("_metadata"))


def enrich(stream: DataFrame, dimension: DataFrame, key: str, dimension_key: str, columns: Sequence[str], as_of: Column, newest: Sequence[Column] = ()) -> DataFrame:
    """Every row with ``columns`` of the dimension, whose values win where they are not null; missing keys and falsy
    keys find nothing. Of a key's dimension rows the first in ``newest`` counts; without an order the dimension must
    have one row a key."""
    old = [c for c in stream.columns if c not in columns]
    # keys of one type are compared as they are, so that a bucketed dimension stays in place
    alike = stream.schema[key].dataType == dimension.schema[dimension_key].dataType
    plain = (lambda c: c) if alike else lambda c: c.cast("string")
    latest = latest_per_key(dimension, [dimension_key], *newest) if newest else dimension
    slim = latest.select(plain(F.col(dimension_key)).alias("_key"), *[F.col(c).alias(f"_dim_{c}") for c in columns])
    own = F.when(~falsy(stream, key), plain(F.col(key)))
    joined = stream.withColumn("_own", own).join(slim, F.col("_own") == F.col("_key"), "left")
    merged = [(F.coalesce(f"_dim_{c}", c) if c in stream.columns else F.col(f"_dim_{c}")).alias(c) for c in columns]
    return joined.select(*old, *merged, as_of.alias("_enrichment_timestamp"))


def flattened(df: DataFrame, family: str) -> DataFrame:
    """The fields of a struct column as columns, which win over columns of the same name."""
    fields = df.schema[family].dataType.names
    own = [F.col(c) for c in df.columns if c != family and c not in fields]
    return df.select(*own, *[F.coalesce(F.col(f"{family}.{f}"), F.col(f)).alias(f) if f in df.columns else F.col(f"{family}.{f}").alias(f) for f in fields])


def reconcile(member: DataFrame, personas: DataFrame, mapping: Sequence[tuple[str, str, str]], key: str, as_of: Column) -> DataFrame:
    """Every member row under technical names: (data, tech, flag) with flag Y takes the persona's value first. Several
    personas of a key give several rows; a null key matches none."""
    columns = []
    taken = {key}
    for data, tech, flag in mapping:
        name = tech or data
        if name in taken or data == key:
            continue
        taken.add(name)
        old = F.col(f"o.`{data}`") if data in member.columns else F.lit(None)
        columns.append((F.coalesce(F.col(f"n.`{name}`"), old) if flag == "Y" and name in personas.columns else old).alias(name))
    joined = member.alias("o").join(personas.alias("n"), F.col(f"o.{key}") == F.col(f"n.{key}"), "left")
    return joined.select(F.col(f"o.{key}").alias(key), *columns, as_of.alias("reconciled_timestamp"), batch_label(as_of).alias("reconciliation_batch"))


def backfill(member: DataFrame, personas: DataFrame, mapping: Sequence[tuple[str, str, str]], key: str, as_of: Column) -> DataFrame:
    """The member table after a matched-only merge: rows whose key has a persona get ``coalesce(persona, own)`` in the
    confirmed columns and ``backfill_timestamp``; others stay. Two personas of one key raise."""
    confirmed = {data: tech or data for data, tech, flag in mapping if flag == "Y" and data != key and data in member.columns and (tech or data) in personas.columns}
    source = personas.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("_n"), *[F.first(t).alias(f"_new_{d}") for d, t in confirmed.items()])
    source = source.withColumn("_hit", F.when(F.col("_n") > 1, F.raise_error(F.lit("more than one source row matches a target row"))).otherwise(F.lit(True)))
    joined = member.join(source, key, "left")
    hit = F.coalesce("_hit", F.lit(False))
    before = F.col("backfill_timestamp") if "backfill_timestamp" in member.columns else F.lit(None)
    out = [F.when(hit, F.coalesce(f"_new_{c}", c)).otherwise(F.col(c)).alias(c) if c in confirmed else F.col(c) for c in member.columns if c != "backfill_timestamp"]
    return joined.select(*out, F.when(hit, as_of).otherwise(before).alias("backfill_timestamp"))


def restricted(existing: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """Rows of ``existing`` whose key is among ``keys``."""
    return existing.join(keys.select(key).distinct(), key, "left_semi")


def with_summary(rows: DataFrame, summary: DataFrame) -> DataFrame:
    """Every row beside a one-row summary."""
    return rows.crossJoin(F.broadcast(summary.limit(1)))


def row_diff(before: DataFrame, after: DataFrame, key: str, fields: Sequence[str]) -> DataFrame:
    """(key, change): added, removed, changed or same, by the rows' hashes."""
    b = before.select(F.col(key), record_hash(before, fields).alias("_b"))
    a = after.select(F.col(key), record_hash(after, fields).alias("_a"))
    change = F.when(F.col("_b").isNull(), "added").when(F.col("_a").isNull(), "removed").when(F.col("_a") == F.col("_b"), "same").otherwise("changed")
    return b.join(a, key, "full").select(key, change.alias("change"))


#: Leaves of the digest tree, as bits, and bits that each level adds.
LEAF_BITS = 16
STEP_BITS = 4


def _leaf(key: Column) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(1 << LEAF_BITS)).cast("int")


def digests(df: DataFrame, key: str, fields: Sequence[str]) -> DataFrame:
    """(leaf, rows, digest): the leaves of a table's hash tree, at most 2^16 rows whatever the table, which can be kept
    beside it. A leaf's digest adds up its records' hashes, so it doesn't depend on their order and repeats count."""
    # the two ends of each record's digest, as numbers, together with the key
    record = record_hash(df, fields)
    each = df.select(_leaf(F.col(key)).alias("leaf"), F.xxhash64(F.col(key), record).cast("decimal(38,0)").alias("h"))
    return each.groupBy("leaf").agg(F.count("*").alias("rows"), F.sum("h").alias("digest"))


def _leaves(digest: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Rows and digests by leaf, digests modulo 2^64: at most 2^16 rows come to the driver."""
    rows, sums = np.zeros(1 << LEAF_BITS, np.int64), np.zeros(1 << LEAF_BITS, np.uint64)
    for leaf, n, h in digest.select("leaf", "rows", "digest").collect():
        rows[leaf], sums[leaf] = n, int(h) & (1 << 64) - 1
    return rows, sums


def differing(before: DataFrame, after: DataFrame) -> DataFrame:
    """(leaf): the leaves in which two tables' ``digests`` differ. From the root down, only children of nodes that differ
    are compared."""
    b, a = _leaves(before), _leaves(after)
    nodes = np.zeros(1, np.int64)
    for bits in range(0, LEAF_BITS + 1, STEP_BITS):
        unlike = np.zeros(len(nodes), bool)
        for x, y in zip(b, a, strict=True):
            of_x, of_y = (v.reshape(1 << bits, -1)[nodes].sum(1) for v in (x, y))
            unlike |= of_x != of_y
        nodes = nodes[unlike]
        if bits < LEAF_BITS:
            nodes = (nodes[:, None] << STEP_BITS | np.arange(1 << STEP_BITS)).ravel()
    return before.sparkSession.createDataFrame([(int(n),) for n in nodes], "leaf int")


def row_diff_by_digest(before: DataFrame, after: DataFrame, key: str, fields: Sequence[str], known: tuple[DataFrame, DataFrame] | None = None) -> DataFrame:
    """``row_diff`` that joins only rows of leaves that differ; rows of equal leaves are the same without a join. The two
    tables' ``digests`` may be given."""
    b, a = known or (digests(before, key, fields), digests(after, key, fields))
    leaves = differing(b, a)
    inside = lambda df, how: df.join(F.broadcast(leaves), _leaf(F.col(key)) == F.col("leaf"), how)  # noqa: E731  2^16 rows at most
    same = inside(after, "left_anti").select(key, F.lit("same").alias("change"))
    return row_diff(inside(before, "left_semi"), inside(after, "left_semi"), key, fields).unionByName(same)


def mapping_triples(mapping: DataFrame, flag_col: str, bound: int = 1000) -> list[tuple[str, str, str]]:
    """(data, tech, flag) rows of a mapping (data_schema, tech_schema, flags), bounded and ordered."""
    rows = mapping.select("data_schema", text_or(F.col("tech_schema"), F.col("data_schema")).alias("tech"), F.when(is_yes(F.col(flag_col)), "Y").otherwise("N").alias("flag"))
    got = rows.orderBy("data_schema", "tech").limit(bound + 1).collect()
    if len(got) > bound:
        raise ValueError(f"a mapping has more than {bound} rows")
    return [tuple(r) for r in got]
