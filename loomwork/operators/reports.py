"""One-row table reports, each one pass over its table, and what is put together from them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomwork.functions.scalars import freshness_label, is_yes, minutes_between, overall_status, recent, volume_label


def quality_row(df: DataFrame, name: str, key: str, ts: str, as_of: Column, hours: int = 2, least: int = 1000) -> DataFrame:
    """Rows, distinct keys and the latest time among the recent rows of a table, and a volume label."""
    return df.where(recent(F.col(ts), as_of, hours)).agg(F.count("*").alias("record_count"), F.count_distinct(F.col(key)).alias("unique_members"), F.max(ts).alias("last_ingested")).select(
        F.lit(name).alias("table_name"), "record_count", "unique_members", "last_ingested", volume_label(F.col("record_count"), least).alias("status")
    )


def daily_row(df: DataFrame, name: str, ts: str, day: Column) -> DataFrame:
    return df.where(F.to_date(ts) == day).agg(F.count("*").alias("record_count"), F.max(ts).alias("last_ingested")).select(F.lit(name).alias("table_name"), "record_count", "last_ingested")


def freshness_row(df: DataFrame, name: str, ts: str, as_of: Column, warn: int = 60, alert: int = 120, no_data: str = "OK") -> DataFrame:
    """The latest time of the day, minutes since, and a label."""
    top = df.where(F.to_date(ts) == F.to_date(as_of)).agg(F.max(ts).alias("last_ingested"))
    minutes = minutes_between(as_of, F.col("last_ingested"))
    return top.select(F.lit(name).alias("table_name"), "last_ingested", minutes.cast("long").alias("minutes_since_update"), freshness_label(minutes, warn, alert, no_data).alias("health_status"))


def mapping_summary(mapping: DataFrame, reconcile_flag: str, confirm_flag: str) -> DataFrame:
    return mapping.agg(F.count("*").alias("total_columns"), F.count_if(is_yes(F.col(reconcile_flag))).alias("reconciling"), F.count_if(is_yes(F.col(confirm_flag))).alias("confirmed"))


def validation_row(df: DataFrame, name: str, ts: str) -> DataFrame:
    return df.agg(F.count("*").alias("record_count"), F.max(ts).alias("last_reconciled")).select(F.lit(name).alias("table_name"), "record_count", "last_reconciled")


def union_all(rows: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, rows)


def health_row(report: DataFrame, as_of: Column, term: str, environment: str) -> DataFrame:
    """The report of a few tables as one log row."""
    listed = F.to_json(F.sort_array(F.collect_list(F.struct("table_name", "minutes_since_update", "health_status"))))
    return report.agg(listed.alias("health_metrics")).select(as_of.alias("check_timestamp"), F.lit(term).alias("term_type"), F.lit(environment).alias("environment"), "health_metrics", overall_status(F.col("health_metrics")).alias("overall_status"))
