"""Early and closing panes of tumbling windows in one stateful operator.

A window fires early, with what has come since its last pane, whenever rows reach it and ``early`` seconds of processing
time have passed since; it closes when the watermark passes its end, with the rest. Panes discard what they have shown, so
a window's panes add up to its rows. A window that has shown all its rows closes with an empty pane. State is three numbers
for each open window. Tasks count their rows by window first, so a busy window sends one row a batch from each task.

Rows of a window that has closed are late and left out; rows without a timestamp too. Early panes follow micro-batches: no
rows, no early pane. After a restart from the checkpoint no pane comes twice in a sink that is exactly once.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

OUTPUT = "window_start timestamp, window_end timestamp, pane int, record_count long, closing boolean"
PROVIDER = "spark.sql.streaming.stateStore.providerClass"


class Panes(StatefulProcessor):
    """Keyed by (window_start, window_end); rows carry ``n``."""

    def __init__(self, early_ms: int):
        self.early_ms = early_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        #: rows since the last pane, panes so far, when the last one was
        self.open = handle.getValueState("open", "n long, panes int, fired long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:  # noqa: N802, N803
        _, end = key
        closes = int(end.timestamp() * 1000)
        if closes <= timerValues.getCurrentWatermarkInMs():
            return
        now = timerValues.getCurrentProcessingTimeInMs()
        if self.open.exists():
            n, panes, fired = self.open.get()
        else:
            n, panes, fired = 0, 0, now
            self.handle.registerTimer(closes)
        n += sum(r.n for r in rows)
        if n and now - fired >= self.early_ms:
            yield Row(window_start=key[0], window_end=end, pane=panes, record_count=n, closing=False)
            n, panes, fired = 0, panes + 1, now
        self.open.update((n, panes, fired))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:  # noqa: N802, N803
        n, panes, _ = self.open.get()
        self.open.clear()
        yield Row(window_start=key[0], window_end=key[1], pane=panes, record_count=n, closing=True)

    def close(self) -> None:
        pass


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        table = pa.Table.from_batches([batch]).group_by(["window_start", "window_end"]).aggregate([("latest", "max"), ("latest", "count")])
        table = table.select(["window_start", "window_end", "latest_max", "latest_count"]).rename_columns(["window_start", "window_end", "latest", "n"])
        yield from table.to_batches()


def fired(stream: DataFrame, ts: str = "timestamp", width: str = "1 hour", early: float = 60, delay: str = "0 seconds") -> DataFrame:
    """OUTPUT: the panes of a stream by the timestamp ``ts``; start it within ``state_store``."""
    windows = stream.where(F.col(ts).isNotNull()).select(F.window(ts, width).alias("w"), F.col(ts).alias("latest"))
    rows = windows.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "latest")
    counts = rows.mapInArrow(_counted, "window_start timestamp, window_end timestamp, latest timestamp, n long")
    keyed = counts.withWatermark("latest", delay).groupBy("window_start", "window_end")
    return keyed.transformWithState(Panes(int(early * 1000)), OUTPUT, "append", "EventTime")


@contextmanager
def state_store(spark: SparkSession) -> Iterator[None]:
    """The state store that this kind of state needs, for queries that are started within the block."""
    before = spark.conf.get(PROVIDER)
    spark.conf.set(PROVIDER, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        yield
    finally:
        spark.conf.set(PROVIDER, before)
