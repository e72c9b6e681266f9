"""Message topics as a data source of their own, for batch and streams, where no broker is at hand.

A topic is a folder of Parquet segments and numbered commits, each a small file that names its segments. Tasks write
segments; the driver makes them visible all at once by linking the next commit, which fails if another writer took that
number, so it takes the one after. A failed write leaves no commit, and its segments go. Readers see committed segments
only, one partition each, and pass over those that a filter on ``publish_time`` or ``commit`` excludes.

A stream's offset is a commit number. A subscription belongs to a topic and keeps its own position beside it, apart from
other subscriptions and from any query's checkpoint: a query that starts without a checkpoint goes on where the last one of
its subscription stopped. A stream that publishes names its writer, and a micro-batch that it repeats is not published twice.

Columns: ``message_id`` (commit, segment and row), ``value``, ``attributes``, ``publish_time``, ``commit``. A row's value may
be null; attributes that aren't given are an empty map. The root must be a folder that driver and executors share, on a
file system with links (a mount); others raise.
"""

from __future__ import annotations

import ast
import json
import os
import uuid
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from datetime import UTC, datetime

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    DataSourceStreamArrowWriter,
    DataSourceStreamReader,
    EqualTo,
    Filter,
    GreaterThan,
    GreaterThanOrEqual,
    InputPartition,
    LessThan,
    LessThanOrEqual,
    WriterCommitMessage,
)
from pyspark.sql.streaming import StreamingQuery

FORMAT = "loomwork_topic"
SCHEMA = "message_id string, value string, attributes map<string,string>, publish_time timestamp, commit long"
SEGMENT = pa.schema([("value", pa.string()), ("attributes", pa.map_(pa.string(), pa.string())), ("publish_time", pa.timestamp("us", "UTC"))])


def _local(path: str) -> str:
    """The path of a folder on a mount."""
    scheme, _, rest = path.partition(":")
    if not rest:
        return path
    if scheme != "file":
        raise ValueError(f"a topic needs a mounted folder: {path}")
    return "/" + rest.lstrip("/")


def _write_new(path: str, data: dict) -> bool:
    """Whether ``path`` is now this file, whole; not if it was there."""
    draft = f"{path}.{uuid.uuid4().hex}"
    with open(draft, "x", encoding="utf-8") as f:
        json.dump(data, f)
    try:
        os.link(draft, path)
    except FileExistsError:
        return False
    finally:
        os.unlink(draft)
    return True


def _read(path: str) -> dict:
    with open(path, encoding="utf-8") as f:
        return json.load(f)


class Topic:
    """The files of a topic."""

    def __init__(self, root: str, name: str):
        self.folder = f"{_local(root)}/topics/{name}"
        self.data, self.log = f"{self.folder}/data", f"{self.folder}/commits"

    def made(self) -> Topic:
        for folder in (self.data, self.log):
            os.makedirs(folder, exist_ok=True)
        return self

    def last(self) -> int:
        try:
            return max((int(n) for n in os.listdir(self.log) if n.isdigit()), default=0)
        except FileNotFoundError:
            return 0

    def commits(self, after: int, till: int) -> Iterator[tuple[int, dict]]:
        for number in range(after + 1, till + 1):
            yield number, _read(f"{self.log}/{number:020d}")

    def publish(self, write: str, segments: list[dict], writer: str = "", batch: int = -1) -> None:
        """Makes the segments of a write visible as one commit; of a writer's batch only once."""
        number = self.last()
        if writer and any(c["writer"] == writer and c["batch"] >= batch for _, c in self.commits(0, number)):
            self.discard(write)
            return
        while not _write_new(f"{self.log}/{number + 1:020d}", {"segments": segments, "writer": writer, "batch": batch}):
            number += 1

    def discard(self, write: str) -> None:
        """The segments of one write that no commit names."""
        named = {s["name"] for _, c in self.commits(0, self.last()) for s in c["segments"]}
        for name in os.listdir(self.data):
            if name.startswith(f"{write}-") and name not in named:
                os.unlink(f"{self.data}/{name}")


class Subscription:
    """A named position in a topic."""

    def __init__(self, root: str, name: str):
        self.path = f"{_local(root)}/subscriptions/{name}"

    def create(self, topic: str, position: int) -> None:
        os.makedirs(os.path.dirname(self.path), exist_ok=True)
        if not _write_new(self.path, {"topic": topic, "position": position}):
            raise ValueError(f"there is such a subscription: {self.path}")

    def read(self) -> dict:
        return _read(self.path)

    def advance(self, position: int) -> None:
        """Forward only: a query that is behind takes nothing back."""
        now = self.read()
        if position > now["position"]:
            draft = f"{self.path}.{uuid.uuid4().hex}"
            with open(draft, "x", encoding="utf-8") as f:
                json.dump(now | {"position": position}, f)
            os.replace(draft, self.path)


@dataclass
class Segment(InputPartition):
    """One file of a commit."""

    path: str
    commit: int
    number: int


@dataclass
class Written(WriterCommitMessage):
    segment: dict | None


def _batches(part: Segment) -> Iterator[pa.RecordBatch]:
    row = 0
    for batch in pq.ParquetFile(part.path).iter_batches(batch_size=4096):
        n = batch.num_rows
        ids = pa.array([f"{part.commit}-{part.number}-{row + i}" for i in range(n)], pa.string())
        row += n
        yield pa.RecordBatch.from_arrays([ids, *batch.columns, pa.array([part.commit] * n, pa.int64())], ["message_id", *SEGMENT.names, "commit"])


def _segments(topic: Topic, after: int, till: int) -> Iterator[tuple[Segment, dict]]:
    for number, commit in topic.commits(after, till):
        for k, s in enumerate(commit["segments"]):
            yield Segment(f"{topic.data}/{s['name']}", number, k), s


def _written(topic: Topic, write: str, batches: Iterator[pa.RecordBatch], now: datetime) -> Written:
    """One task's segment; nothing is left of it if the task fails."""
    name, rows, low, high = f"{write}-{uuid.uuid4().hex}.parquet", 0, None, None
    path = f"{topic.data}/{name}"
    try:
        with pq.ParquetWriter(path, SEGMENT, compression="zstd") as out:
            for batch in batches:
                n, given = batch.num_rows, dict(zip(batch.schema.names, batch.columns, strict=True))
                attributes = given.get("attributes", pa.nulls(n)).cast(SEGMENT.field("attributes").type)
                empty = pa.array([[]] * n, attributes.type)
                times = given["publish_time"].cast(pa.timestamp("us", "UTC")) if "publish_time" in given else pa.array([now] * n, pa.timestamp("us", "UTC"))
                filled = pa.compute.if_else(attributes.is_valid(), attributes, empty) if attributes.null_count else attributes
                out.write_batch(pa.RecordBatch.from_arrays([given["value"].cast(pa.string()), filled, times], schema=SEGMENT))
                known = [t.timestamp() for t in times.to_pylist() if t is not None]
                if known:
                    low, high = min([*known, *([] if low is None else [low])]), max([*known, *([] if high is None else [high])])
                rows += n
    except BaseException:
        if os.path.exists(path):
            os.unlink(path)
        raise
    if not rows:
        os.unlink(path)
        return Written(None)
    return Written({"name": name, "rows": rows, "low": low, "high": high})


def _named(messages: list[WriterCommitMessage | None]) -> list[dict]:
    return [m.segment for m in messages if isinstance(m, Written) and m.segment]


class TopicSource(DataSource):
    """Options: ``root``, ``topic`` or ``subscription``, ``writer`` and ``publish_time`` for writes."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return SCHEMA

    def _subscription(self) -> Subscription | None:
        name = self.options.get("subscription")
        return Subscription(self.options["root"], name) if name else None

    def _topic(self) -> Topic:
        held = self._subscription()
        name = held.read()["topic"] if held else self.options.get("topic")
        if not name:
            raise ValueError("a topic or a subscription is needed")
        return Topic(self.options["root"], name)

    def _now(self) -> datetime:
        given = self.options.get("publish_time")
        return datetime.fromisoformat(given) if given else datetime.now(UTC)

    def reader(self, schema) -> TopicReader:
        return TopicReader(self._topic())

    def streamReader(self, schema) -> TopicStream:  # noqa: N802
        return TopicStream(self._topic(), self._subscription())

    def writer(self, schema, overwrite: bool) -> TopicWriter:
        if overwrite:
            raise ValueError("a topic is only appended to")
        return TopicWriter(self._topic().made(), self._now())

    def streamWriter(self, schema, overwrite: bool) -> TopicStreamWriter:  # noqa: N802
        return TopicStreamWriter(self._topic().made(), self._now(), self.options["writer"])


class TopicReader(DataSourceReader):
    """All that is committed when the read is planned."""

    def __init__(self, topic: Topic):
        self.topic = topic
        self.bounds: list[tuple[str, str, float]] = []

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:  # noqa: N802
        signs = {EqualTo: "=", GreaterThan: ">", GreaterThanOrEqual: ">=", LessThan: "<", LessThanOrEqual: "<="}
        for f in filters:
            if type(f) in signs and f.attribute in (("publish_time",), ("commit",)):
                value = f.value.timestamp() if isinstance(f.value, datetime) else f.value
                self.bounds.append((f.attribute[0], signs[type(f)], value))
                if f.attribute == ("commit",):
                    continue  # a segment has one commit, so this is decided
            yield f

    def _may_hold(self, part: Segment, s: dict) -> bool:
        for column, sign, value in self.bounds:
            low, high = (part.commit, part.commit) if column == "commit" else (s["low"], s["high"])
            if low is None or sign in (">", ">=", "=") and (high < value or sign == ">" and high == value) or sign in ("<", "<=", "=") and (low > value or sign == "<" and low == value):
                return False
        return True

    def partitions(self) -> Sequence[Segment]:
        return [part for part, s in _segments(self.topic, 0, self.topic.last()) if self._may_hold(part, s)]

    def read(self, partition: Segment) -> Iterator[pa.RecordBatch]:
        if isinstance(partition, Segment):  # a read without partitions comes with none
            yield from _batches(partition)


class TopicStream(DataSourceStreamReader):
    """Offsets are commit numbers; a subscription's position follows what queries have finished."""

    def __init__(self, topic: Topic, held: Subscription | None):
        self.topic, self.held = topic, held

    def initialOffset(self) -> dict:  # noqa: N802
        return {"commit": self.held.read()["position"] if self.held else 0}

    def latestOffset(self) -> dict:  # noqa: N802
        return {"commit": self.topic.last()}

    def partitions(self, start: dict, end: dict) -> Sequence[Segment]:
        return [part for part, _ in _segments(self.topic, start["commit"], end["commit"])]

    def read(self, partition: Segment) -> Iterator[pa.RecordBatch]:
        if isinstance(partition, Segment):
            yield from _batches(partition)

    def commit(self, end: dict) -> None:
        if self.held:
            self.held.advance(end["commit"])


class TopicWriter(DataSourceArrowWriter):
    def __init__(self, topic: Topic, now: datetime):
        self.topic, self.now, self.id = topic, now, uuid.uuid4().hex

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        return _written(self.topic, self.id, iterator, self.now)

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        if segments := _named(messages):
            self.topic.publish(self.id, segments)

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        self.topic.discard(self.id)


class TopicStreamWriter(DataSourceStreamArrowWriter):
    def __init__(self, topic: Topic, now: datetime, writer: str):
        self.topic, self.now, self.writer, self.id = topic, now, writer, uuid.uuid4().hex

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        return _written(self.topic, self.id, iterator, self.now)

    def commit(self, messages: list[WriterCommitMessage | None], batchId: int) -> None:  # noqa: N803
        if segments := _named(messages):
            self.topic.publish(self.id, segments, self.writer, batchId)

    def abort(self, messages: list[WriterCommitMessage | None], batchId: int) -> None:  # noqa: N803
        self.topic.discard(self.id)


def registered(spark: SparkSession) -> SparkSession:
    """``spark`` with the format known and its filters pushed."""
    spark.dataSource.register(TopicSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    return spark


def subscribe(root: str, topic: str, name: str, from_start: bool = True) -> None:
    """A new subscription, from the topic's first message or from the next one on."""
    Subscription(root, name).create(topic, 0 if from_start else Topic(root, topic).last())


def _shaped(df: DataFrame, with_attributes: bool) -> DataFrame:
    return df if with_attributes else df.select("value")


def read_topic(spark: SparkSession, root: str, topic: str | None = None, subscription: str | None = None, with_attributes: bool = False) -> DataFrame:
    """A topic's messages as they are now: values, or all columns ``with_attributes``."""
    named = {"subscription": subscription} if subscription else {"topic": topic or ""}
    return _shaped(registered(spark).read.format(FORMAT).options(root=root, **named).load(), with_attributes)


def stream_topic(spark: SparkSession, root: str, topic: str | None = None, subscription: str | None = None, with_attributes: bool = False, id_label: str | None = None, delay: str = "10 minutes") -> DataFrame:
    """A stream of messages; a subscription wins over a topic. Of messages with the same attribute ``id_label`` the first
    stays, within ``delay`` of publishing; without that attribute a message's own id counts."""
    named = {"subscription": subscription} if subscription else {"topic": topic or ""}
    rows = registered(spark).readStream.format(FORMAT).options(root=root, **named).load()
    if id_label:
        marked = rows.withColumn("_id", F.coalesce(F.col("attributes")[id_label], "message_id"))
        rows = marked.withWatermark("publish_time", delay).dropDuplicatesWithinWatermark(["_id"]).drop("_id")
    return _shaped(rows, with_attributes)


def finished(query: StreamingQuery, root: str, subscription: str) -> None:
    """Waits for a query of one subscription to end, and moves the subscription behind its last batch: Spark tells a source
    of a finished batch only when it plans the next. A query that fails raises, and its last batch is delivered again."""
    query.awaitTermination()
    done = [ast.literal_eval(str(s["endOffset"])) for p in query.recentProgress for s in p["sources"] if s["endOffset"]]
    if done:
        Subscription(root, subscription).advance(max(d["commit"] for d in done))


def publish(df: DataFrame, root: str, topic: str, publish_time: str | None = None) -> None:
    """Rows of (value, attributes?, publish_time?) as one commit."""
    given = {"publish_time": publish_time} if publish_time else {}
    registered(df.sparkSession)
    df.write.format(FORMAT).mode("append").options(root=root, topic=topic, **given).save()


def publish_stream(df: DataFrame, root: str, topic: str, writer: str, checkpoint: str, **trigger) -> StreamingQuery:
    """A stream of such rows, each micro-batch one commit, exactly once by ``writer``."""
    registered(df.sparkSession)
    out = df.writeStream.format(FORMAT).options(root=root, topic=topic, writer=writer).option("checkpointLocation", checkpoint)
    return out.trigger(**(trigger or {"availableNow": True})).start()
