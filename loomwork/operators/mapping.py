"""Column mappings: read as a table of (output column, input column) pairs, compiled into one projection."""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loomwork.functions.scalars import is_yes, text_or

#: Rows that a mapping may have; more raises, so what reaches the driver is bounded.
MAX_ROWS = 1000
KEYS = (("member_id", "member_number"), ("member_number", "member_number"))
NO_DATE = "1999-12-31"


def latest_snapshot(mapping: DataFrame, date_col: str, where: Column | None = None) -> DataFrame:
    """Rows of the latest date; undated rows count as NO_DATE. The maximum is one broadcast row, not a window."""
    day = F.coalesce(F.to_date(date_col), F.to_date(F.lit(NO_DATE)))
    rows = mapping if where is None else mapping.where(where)
    top = rows.agg(F.max(day).alias("_top"))
    return rows.join(F.broadcast(top), day == F.col("_top")).drop("_top")


def derived(mapping: DataFrame, data_col: str, tech_col: str, ongoing_flag: str, origin_flag: str) -> DataFrame:
    """(out_col, ongoing_in, origin_in): each reads the technical name where its flag is Y, else the data name. Of
    several rows for one output the one with the highest technical name is taken."""
    tech = text_or(F.col(tech_col), F.col(data_col))
    rows = mapping.select(
        F.col(data_col).alias("out_col"),
        F.when(is_yes(F.col(ongoing_flag)), tech).otherwise(F.col(data_col)).alias("ongoing_in"),
        F.when(is_yes(F.col(origin_flag)), tech).otherwise(F.col(data_col)).alias("origin_in"),
        tech.alias("_tech"),
    )
    order = Window.partitionBy("out_col").orderBy(F.desc("_tech"), F.desc("ongoing_in"), F.desc("origin_in"))
    return rows.withColumn("_n", F.row_number().over(order)).where("_n = 1").drop("_n", "_tech")


def with_keys(mapping: DataFrame) -> DataFrame:
    """Both key columns are outputs, read from the member number, unless that is mapped already."""
    keys = mapping.sparkSession.createDataFrame([(o, i, i) for o, i in KEYS], mapping.schema.simpleString().removeprefix("struct<").removesuffix(">"))
    mapped = mapping.where(F.col("out_col") == "member_number").agg(F.count("*").alias("_mapped"))
    added = keys.join(F.broadcast(mapped)).where("_mapped = 0").drop("_mapped")
    kept = mapping.join(F.broadcast(added.select("out_col")), "out_col", "left_anti")
    return kept.unionByName(added)


def default_mapping(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(o, i, i) for o, i in KEYS], "out_col string, ongoing_in string, origin_in string")


def loaded(spark: SparkSession, table: str, date_col: str = "updated_date", **columns: str) -> DataFrame:
    """The mapping in a table; the default one where the table is absent or empty. Other errors surface."""
    if not spark.catalog.tableExists(table):
        return default_mapping(spark)
    rows = spark.table(table)
    if rows.isEmpty():
        return default_mapping(spark)
    return with_keys(derived(latest_snapshot(rows, date_col), **columns))


def pairs(mapping: DataFrame, kind: str) -> list[tuple[str, str]]:
    """The (output, input) names of one kind, ``ongoing`` or ``origin``, in name order."""
    rows = mapping.select("out_col", f"{kind}_in").orderBy("out_col").limit(MAX_ROWS + 1).collect()
    if len(rows) > MAX_ROWS:
        raise ValueError(f"a mapping has more than {MAX_ROWS} rows")
    return [(r[0], r[1]) for r in rows]


def picked(df: DataFrame, name: str, alias: str) -> Column:
    return (F.col(f"`{name}`") if name in df.columns else F.lit(None).cast("string")).alias(alias)


def batch_metadata(as_of: Column, source: str, target: str, version: str = "1.0.0") -> Column:
    return F.struct(as_of.alias("ingested_at"), as_of.alias("processed_at"), F.lit(source).alias("source_table"), F.lit(target).alias("target_table"), F.lit(version).alias("pipeline_version")).alias("_metadata")


def stream_metadata(df: DataFrame, as_of: Column, target: str) -> Column:
    stamp = F.coalesce("_timestamp", as_of) if "_timestamp" in df.columns else as_of
    return F.struct(as_of.alias("ingested_at"), as_of.alias("processed_at"), F.lit(target).alias("target_table"), stamp.alias("stream_timestamp")).alias("_metadata")


def map_columns(df: DataFrame, columns: list[tuple[str, str]], metadata: Column | None = None) -> DataFrame:
    """Exactly the mapping's outputs, in one projection; an absent input gives null."""
    return df.select(*[picked(df, i, o) for o, i in columns], *([] if metadata is None else [metadata]))


def stamped(df: DataFrame, as_of: Column) -> DataFrame:
    return df.withColumn("ingested_at", as_of)


class Refreshed:
    """A driver-side value that is loaded again once it is older than ``seconds``: mappings of streams, whose plans
    would otherwise keep the rows they were made with."""

    def __init__(self, load: Callable[[], object], seconds: float = 600, clock: Callable[[], float] = time.monotonic):
        self._load, self._seconds, self._clock = load, seconds, clock
        self._value, self._at = None, None

    def __call__(self):
        now = self._clock()
        if self._at is None or now - self._at >= self._seconds:
            self._value, self._at = self._load(), now
        return self._value
