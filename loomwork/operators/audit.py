"""Audit rows and rollups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def audit_rows(df: DataFrame, pipeline: str, step: str, record_id: str, as_of: Column) -> DataFrame:
    """One row a record; the status is its quality status, else PROCESSED."""
    status = F.coalesce("_dq_status", F.lit("PROCESSED")) if "_dq_status" in df.columns else F.lit("PROCESSED")
    return df.select(as_of.alias("job_time"), F.lit(pipeline).alias("pipeline"), F.lit(step).alias("step"), F.col(record_id).cast("string").alias("record_id"), status.alias("status"))


def audit_projection(df: DataFrame, key: str, ts: str) -> DataFrame:
    """(member_number, timestamp, _dq_status): what the windowed rollup reads."""
    status = F.coalesce("_dq_status", F.lit("UNKNOWN")) if "_dq_status" in df.columns else F.lit("UNKNOWN")
    return df.select(F.col(key).alias("member_number"), F.col(ts).alias("timestamp"), status.alias("_dq_status"))


def by_window_and_id(rows: DataFrame, width: str = "1 hour") -> DataFrame:
    """The first of two aggregation levels, which makes distinct ids exact in streams too; the null id is one id."""
    return rows.groupBy(F.window("timestamp", width).alias("window"), "member_number").agg(
        F.count("*").alias("n"),
        F.count_if(F.col("_dq_status") == "FAILED").alias("failed"),
        F.min("timestamp").alias("first_seen"),
        F.max("timestamp").alias("last_seen"),
    )


def merged_by_id(by_id: DataFrame) -> DataFrame:
    """Counts of ``by_window_and_id`` from several batches as one row a window and id."""
    return by_id.groupBy("window", "member_number").agg(F.sum("n").alias("n"), F.sum("failed").alias("failed"), F.min("first_seen").alias("first_seen"), F.max("last_seen").alias("last_seen"))


def window_totals(by_id: DataFrame) -> DataFrame:
    n, failed = F.sum("n"), F.sum("failed")
    seconds = F.unix_timestamp(F.max("last_seen").cast("timestamp")) - F.unix_timestamp(F.min("first_seen").cast("timestamp"))
    return by_id.groupBy("window").agg(
        n.alias("records_processed"),
        F.count("*").alias("unique_count"),
        failed.alias("error_count"),
        ((n - failed) / F.greatest(n, F.lit(1))).alias("success_rate"),
        F.min("first_seen").alias("first_seen"),
        F.max("last_seen").alias("last_seen"),
        seconds.alias("duration_seconds"),
    ).select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), "records_processed", "unique_count", "error_count", "success_rate", "first_seen", "last_seen", "duration_seconds")


def windowed_audit(rows: DataFrame, width: str = "1 hour") -> DataFrame:
    """Per window of (member_number, timestamp, _dq_status): counts, exact distinct ids, errors, success rate, first
    and last seen. Both levels combine before they shuffle, so neither a busy window nor a busy id is a hot key."""
    return window_totals(by_window_and_id(rows, width))


def window_trace(df: DataFrame, ts: str, width: str = "1 hour") -> DataFrame:
    """Count, first and last time of each window."""
    traced = df.groupBy(F.window(ts, width).alias("w")).agg(F.count("*").alias("record_count"), F.min(ts).alias("first_seen"), F.max(ts).alias("last_seen"))
    return traced.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "record_count", "first_seen", "last_seen")


def metric_rollup(samples: DataFrame) -> DataFrame:
    """(name, kind, value, seq) to one row a name: counters add up, gauges keep the last value, histograms are
    described. A name's kind is that of its first sample; unknown kinds are left out."""
    kinds = samples.groupBy("name").agg(F.min_by("kind", "seq").alias("kind"), F.sum("value").alias("total"), F.max_by("value", "seq").alias("last"), F.count("*").alias("n"), F.avg("value").alias("mean"), F.min("value").alias("low"), F.max("value").alias("high"))
    hist = F.col("kind") == "histogram"
    value = F.when(F.col("kind") == "counter", F.col("total")).when(F.col("kind") == "gauge", F.col("last"))
    described = {"sample_count": "n", "sample_sum": "total", "sample_avg": "mean", "sample_min": "low", "sample_max": "high"}
    return kinds.where(F.col("kind").isin("counter", "gauge", "histogram")).select("name", "kind", value.alias("value"), *[F.when(hist, F.col(c)).alias(a) for a, c in described.items()])


def error_digest(errors: DataFrame, order: list[Column], first: int = 10) -> DataFrame:
    """The first errors, each beside the count of all."""
    total = errors.agg(F.count("*").alias("error_count"))
    return errors.orderBy(*order).limit(first).crossJoin(F.broadcast(total))


def latest_rows(log: DataFrame, ts: str, day: Column, tie: Column, n: int = 10) -> DataFrame:
    """The newest ``n`` rows of a day, which is what the report is."""
    return log.where(F.to_date(ts) == day).orderBy(F.desc(ts), tie).limit(n)
