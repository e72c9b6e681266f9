"""Structured Streaming: notifications, windows and sinks."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from loomwork.functions.scalars import first_truthy, parsed_json
from loomwork.operators.audit import by_window_and_id, merged_by_id, window_totals
from loomwork.sources.workspace import deleted, exists

KEYS = ("member_number", "profileId", "member_id")
NOTIFICATION = "member_number string, profileId string, member_id string, type string"


def notifications(df: DataFrame, value: str, as_of: Column, schema: str = NOTIFICATION) -> DataFrame:
    """The fields of JSON messages with ``member_number`` (the first truthy key), ``_timestamp`` and
    ``_notification_type``. Malformed messages and those without a key are dropped. Fields arrive as text, in which a
    JSON 0 or false is '0' or 'false': these count as missing."""
    others = [c for c in df.columns if c != value]
    parsed = df.select(*others, parsed_json(F.col(value), schema).alias("_m")).where("_m is not null").select(*others, "_m.*")
    cleaned = parsed.withColumns({k: F.when(F.col(k).isin("0", "0.0", "false"), F.lit(None)).otherwise(F.col(k)) for k in KEYS if k in parsed.columns})
    keyed = cleaned.withColumn("member_number", first_truthy(cleaned, KEYS)).where("member_number is not null")
    return keyed.withColumn("_timestamp", as_of).withColumn("_notification_type", F.coalesce(F.nullif("type", F.lit("")), F.lit("update")))


def stream_audit(rows: DataFrame, width: str = "1 hour", delay: str = "0 seconds") -> DataFrame:
    """The windowed audit of a stream of (member_number, timestamp, _dq_status): exact, emitted once, when the
    watermark has passed the window."""
    first = by_window_and_id(rows.withWatermark("timestamp", delay), width)
    return window_totals(first)


def panes(batch: DataFrame, batch_id: int, width: str = "1 hour") -> DataFrame:
    """What one micro-batch adds to each window: the discarding early panes, without state."""
    by = batch.groupBy(F.window("timestamp", width).alias("w")).agg(F.count("*").alias("record_count"))
    return by.select(F.lit(batch_id).cast("long").alias("batch_id"), F.col("w.start").alias("window_start"), "record_count")


def once(batch: DataFrame, batch_id: int, path: str) -> None:
    """Write a micro-batch so that a repeated one replaces itself."""
    batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")


def audit_batch(rows: DataFrame, batch_id: int, root: str, width: str = "1 hour", delay: str = "0 seconds") -> None:
    """What one micro-batch of (member_number, timestamp, _dq_status) does to the windowed audit, for use beside other
    sinks of the same batch: open windows are kept as mergeable counts by window and id below ``root``/open, and windows
    that the watermark has passed are appended, once, to ``root``/closed.

    The watermark is the latest timestamp so far less ``delay``. Rows of a window that was closed before the batch are late
    and left out, as Spark's own windows do. A repeated batch reads the same state again and replaces its own output. The
    state holds what open windows have of ids; the one before the last is deleted."""
    spark = rows.sparkSession
    state = lambda n: f"{root}/open/batch_id={n}"
    seen = lambda n: f"{root}/seen/batch_id={n}"
    began = batch_id > 0 and exists(spark, seen(batch_id - 1))
    before = spark.read.parquet(seen(batch_id - 1)).first()[0] if began else None
    now = rows.agg(F.max("timestamp")).first()[0]
    latest = max((t for t in (before, now) if t is not None), default=None)
    kind = rows.schema["timestamp"].dataType
    mark = lambda t: F.lit(t).cast(kind) - F.expr(f"interval {delay}")
    first = by_window_and_id(rows, width)
    if before is not None:
        first = first.where(F.col("window.end") > mark(before))
    if began:
        first = merged_by_id(first.unionByName(spark.read.schema(first.schema).parquet(state(batch_id - 1))))
    closed = F.col("window.end") <= mark(latest) if latest is not None else F.lit(False)
    first = first.persist()
    try:
        first.where(~closed).write.mode("overwrite").parquet(state(batch_id))
        window_totals(first.where(closed)).write.mode("overwrite").parquet(f"{root}/closed/batch_id={batch_id}")
    finally:
        first.unpersist()
    spark.createDataFrame([(latest,)], f"seen {kind.simpleString()}").write.mode("overwrite").parquet(seen(batch_id))
    for old in (state(batch_id - 2), seen(batch_id - 2)):
        deleted(spark, old)


def fan_out(stream: DataFrame, checkpoint: str, sinks: dict[str, Callable[[DataFrame, int], DataFrame]], exactly_once: bool = True, prepare: Callable[[DataFrame], DataFrame] | None = None, audits: dict[str, Callable[[DataFrame], DataFrame]] | None = None, **trigger) -> StreamingQuery:
    """Each micro-batch into several sinks (path: how to make its rows) and windowed audits (root: how to make the rows that
    are audited), all from one read and one persisted frame, which ``prepare`` makes of the batch."""

    def work(batch: DataFrame, batch_id: int) -> None:
        rows = (prepare(batch) if prepare else batch).persist()
        try:
            for path, make in sinks.items():
                made = make(rows, batch_id)
                if exactly_once:
                    once(made, batch_id, path)
                else:
                    made.write.mode("append").parquet(path)
            for root, make in (audits or {}).items():
                audit_batch(make(rows), batch_id, root)
        finally:
            rows.unpersist()

    return stream.writeStream.foreachBatch(work).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()


def to_files(stream: DataFrame, path: str, checkpoint: str, **trigger) -> StreamingQuery:
    """Append to files, exactly once."""
    return stream.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start(path)


class Counted(StreamingQueryListener):
    """Takes the observed counters of each micro-batch of a stream (``quality.observed`` under ``name``) as rows of a table,
    one folder a batch, so that a batch reported twice stands once. Streams of other names are passed over."""

    def __init__(self, spark: SparkSession, name: str, path: str):
        self.spark, self.name, self.path = spark, name, path
        self.failed: list[str] = []

    def onQueryStarted(self, event) -> None:  # noqa: N802
        pass

    def onQueryProgress(self, event) -> None:  # noqa: N802
        counted = event.progress.observedMetrics.get(self.name)
        if counted is not None:
            found = counted.asDict()
            schema = ", ".join(f"`{c}` long" for c in found)
            self.spark.createDataFrame([tuple(found.values())], schema).write.mode("overwrite").parquet(f"{self.path}/batch_id={event.progress.batchId}")

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        if event.exception:
            self.failed.append(event.exception)


@contextmanager
def counted(spark: SparkSession, name: str, path: str) -> Iterator[Counted]:
    """A listener for the streams that run within the block."""
    listener = Counted(spark, name, path)
    spark.streams.addListener(listener)
    try:
        yield listener
    finally:
        # reports that are still on their way count
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
        spark.streams.removeListener(listener)


def pipeline_counters(spark: SparkSession, path: str, failed: int = 0) -> DataFrame:
    """One row over all batches counted below ``path``: rows and errors in total and what failed."""
    batches = spark.read.parquet(path)
    sums = [F.sum(c).alias(c) for c in batches.columns if c != "batch_id"]
    return batches.agg(F.count("*").alias("batches"), *sums).withColumn("failed_queries", F.lit(failed).cast("long"))
