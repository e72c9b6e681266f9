"""Sources: Spark's own readers behind the names the jobs use."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loomwork.sources import topics

FORMATS = ("parquet", "json", "text", "avro")


def scan(spark: SparkSession, table: str | None = None, query: str | None = None, dataset: str | None = None) -> DataFrame:
    """A query's result, else a table, whose name gets the dataset's prefix unless it has one."""
    if query:
        return spark.sql(query)
    if not table:
        raise ValueError("a table or a query is needed")
    return spark.table(f"{dataset}.{table}" if dataset and "." not in table else table)


def partition_scan(df: DataFrame, condition: str | None = None, date_col: str = "ingest_date", as_of: Column | None = None) -> DataFrame:
    """Rows under ``condition``, or of the day of ``as_of``; on a partition column this prunes files."""
    if condition:
        return df.where(F.expr(condition))
    return df.where(F.col(date_col) == F.to_date(as_of if as_of is not None else F.current_timestamp()))


def files(spark: SparkSession, path: str, format: str = "parquet", schema: str | None = None) -> DataFrame:
    """Parquet, JSON lines, text or (with its package) avro below a path."""
    if format not in FORMATS:
        raise ValueError(f"unknown format: {format}")
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.format(format).load(path)


def bounded(df: DataFrame, fields: Sequence[str], max_results: int, *order: Column) -> DataFrame:
    """The first rows in ``order``, of the chosen columns."""
    return df.select(*fields).orderBy(*order).limit(max_results)


def keyed_dimension(df: DataFrame, columns: Sequence[str] | None = None, keys: DataFrame | None = None, key: str = "member_number") -> DataFrame:
    """A dimension's rows, restricted to columns and to keys where given."""
    out = df if columns is None else df.select(key, *[c for c in columns if c != key])
    return out if keys is None else out.join(keys.select(key).distinct(), key, "left_semi")


def messages(spark: SparkSession, topic: str | None = None, subscription: str | None = None, schema: str = "value string", glob: str | None = None, root: str | None = None, with_attributes: bool = False, id_label: str | None = None, **options: str) -> DataFrame:
    """A stream of messages; a subscription wins over a topic. Under ``root`` the names are those of ``topics``. With
    ``kafka.bootstrap.servers`` among the options, and its package, the topic is Kafka's and a subscription is the group
    that reads it. Else they are folders of message files."""
    if not (subscription or topic):
        raise ValueError("a topic or a subscription is needed")
    if root:
        return topics.stream_topic(spark, root, topic, subscription, with_attributes, id_label)
    if "kafka.bootstrap.servers" in options:
        if not topic:
            raise ValueError("a group needs a topic to read")
        group = {"kafka.group.id": subscription} if subscription else {}
        return spark.readStream.format("kafka").options(includeHeaders=with_attributes, **group, **options).option("subscribe", topic).load()
    form = options.pop("format", "json")
    reader = spark.readStream.format(form).schema(schema).options(**options)
    return (reader if glob is None else reader.option("pathGlobFilter", glob)).load(subscription or topic)


def deduplicated(stream: DataFrame, id_col: str, ts: str, delay: str = "10 minutes") -> DataFrame:
    """Redelivered messages go, within the watermark, which bounds the state."""
    return stream.withWatermark(ts, delay).dropDuplicatesWithinWatermark([id_col])


def read_source(spark: SparkSession, kind: str, **settings) -> DataFrame:
    """A source by its type: table, messages, keyed or files."""
    made = {"table": scan, "messages": messages, "files": files}
    if kind == "keyed":
        return keyed_dimension(scan(spark, settings.pop("table")), **settings)
    if kind not in made:
        raise ValueError(f"unknown source type: {kind}")
    return made[kind](spark, **settings)
