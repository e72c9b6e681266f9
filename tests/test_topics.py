"""The topic data source: two-phase writes, pushed filters, subscriptions, streams."""

import os

import pytest
from pyspark.sql import functions as F

from loomwork.sources import readers, topics


def rows_of(spark, *rows):
    return spark.createDataFrame(rows, "value string, attributes map<string,string>, publish_time timestamp")


def sent(spark, root, *values, topic="t"):
    topics.publish(spark.createDataFrame([(v,) for v in values], "value string"), root, topic, "2024-01-01T00:00:00+00:00")


def got(query_rows):
    return sorted(r.value for r in query_rows.collect())


def test_round_trip_with_attributes(spark, tmp_path):
    root = str(tmp_path)
    at = "timestamp'2024-01-01 10:00:00'"
    df = spark.range(40).repartition(4).select(F.col("id").cast("string").alias("value"), F.create_map(F.lit("k"), F.col("id").cast("string")).alias("attributes"), F.expr(f"{at} + make_interval(0,0,0,id)").alias("publish_time"))
    topics.publish(df, root, "t")
    topics.publish(rows_of(spark, (None, None, None)), root, "t")
    back = topics.read_topic(spark, root, "t", with_attributes=True)
    assert back.count() == 41 and back.select("message_id").distinct().count() == 41
    assert {r.value: r.attributes for r in back.where("commit = 1").collect()} == {str(i): {"k": str(i)} for i in range(40)}
    assert back.where("commit = 2").first().attributes == {}
    assert topics.read_topic(spark, root, "t").columns == ["value"]


def test_filters_reach_the_partitions(spark, tmp_path):
    root = str(tmp_path)
    for day in (1, 2, 3):
        topics.publish(spark.createDataFrame([(f"m{day}",)], "value string"), root, "t", f"2024-01-0{day}T00:00:00+00:00")
    every = topics.read_topic(spark, root, "t", with_attributes=True)
    late = every.where("publish_time >= timestamp'2024-01-02 00:00:00'")
    assert got(late) == ["m2", "m3"] and late.rdd.getNumPartitions() == 2
    assert every.where("commit = 2").rdd.getNumPartitions() == 1 and got(every.where("commit = 2")) == ["m2"]
    assert got(every.where("publish_time < timestamp'2024-01-02 00:00:00'")) == ["m1"]
    assert got(every.where("commit > 3")) == []


def test_a_failed_task_leaves_nothing(spark, tmp_path):
    root = str(tmp_path)
    sent(spark, root, "before")
    bad = spark.range(100).repartition(4).select(F.when(F.col("id") == 57, F.raise_error(F.lit("no"))).otherwise(F.col("id").cast("string")).alias("value"))
    with pytest.raises(Exception, match="no"):
        topics.publish(bad, root, "t")
    assert got(topics.read_topic(spark, root, "t")) == ["before"]
    assert len(os.listdir(topics.Topic(root, "t").data)) == 1


def test_two_writers_take_two_commits(spark, tmp_path):
    topic = topics.Topic(str(tmp_path), "t").made()
    assert topics._write_new(f"{topic.log}/{1:020d}", {"segments": [], "writer": "", "batch": -1})
    assert not topics._write_new(f"{topic.log}/{1:020d}", {})
    sent(spark, str(tmp_path), "x")
    assert topic.last() == 2 and got(topics.read_topic(spark, str(tmp_path), "t")) == ["x"]


def drained(spark, root, out, checkpoint, **named):
    stream = topics.stream_topic(spark, root, with_attributes=True, **named)
    query = stream.select("value").writeStream.format("parquet").option("checkpointLocation", checkpoint).trigger(availableNow=True).start(out)
    topics.finished(query, root, named["subscription"]) if "subscription" in named else query.awaitTermination()
    return got(spark.read.schema("value string").parquet(out))


def test_subscriptions_progress_apart(spark, tmp_path):
    root = str(tmp_path)
    sent(spark, root, "a")
    topics.subscribe(root, "t", "early")
    topics.subscribe(root, "t", "late", from_start=False)
    with pytest.raises(ValueError, match="such a subscription"):
        topics.subscribe(root, "t", "early")
    sent(spark, root, "b")
    assert drained(spark, root, f"{root}/o1", f"{root}/c1", subscription="early") == ["a", "b"]
    sent(spark, root, "c")
    assert drained(spark, root, f"{root}/o2", f"{root}/c2", subscription="late") == ["b", "c"]
    # a query of its own, without the other's checkpoint, goes on from the subscription's position
    assert topics.Subscription(root, "early").read()["position"] == 2
    assert drained(spark, root, f"{root}/o3", f"{root}/c3", subscription="early") == ["c"]
    # a topic alone has no position, and a checkpoint keeps its own
    assert drained(spark, root, f"{root}/o4", f"{root}/c4", topic="t") == ["a", "b", "c"]
    assert drained(spark, root, f"{root}/o1", f"{root}/c1", subscription="early") == ["a", "b", "c"]


def test_publish_in_a_stream_once(spark, tmp_path):
    root = str(tmp_path)
    sent(spark, root, "a", "b", topic="in")
    copied = lambda: topics.publish_stream(topics.stream_topic(spark, root, "in", with_attributes=True).select("value", F.create_map(F.lit("from"), "message_id").alias("attributes"), "publish_time"), root, "out", "copier", f"{root}/c").awaitTermination()
    copied()
    sent(spark, root, "c", topic="in")
    copied()
    out = topics.read_topic(spark, root, "out", with_attributes=True)
    assert got(out) == ["a", "b", "c"] and out.where("attributes['from'] is null").isEmpty()
    again = topics.Topic(root, "out")
    before = again.last()
    name = "w-x.parquet"
    open(f"{again.data}/{name}", "w").close()
    again.publish("w", [{"name": name, "rows": 1, "low": None, "high": None}], "copier", 0)  # the first batch, repeated
    assert again.last() == before and not os.path.exists(f"{again.data}/{name}")


def test_redelivered_messages_by_attribute(spark, tmp_path):
    root = str(tmp_path)
    topics.publish(rows_of(spark, ("a", {"id": "1"}, None), ("a2", {"id": "1"}, None), ("b", {}, None)).drop("publish_time"), root, "t")
    topics.subscribe(root, "t", "s")
    rows = readers.messages(spark, subscription="s", root=root, id_label="id")
    rows.writeStream.format("parquet").option("checkpointLocation", f"{root}/c").trigger(availableNow=True).start(f"{root}/o").awaitTermination()
    values = got(spark.read.parquet(f"{root}/o"))
    assert len(values) == 2 and values[-1] == "b"


def test_errors(spark, tmp_path):
    with pytest.raises(Exception, match="topic or a subscription"):
        topics.read_topic(spark, str(tmp_path)).count()
    with pytest.raises(Exception, match="mounted folder"):
        topics.read_topic(spark, "s3://bucket/x", "t").count()
    with pytest.raises(ValueError, match="needs a topic"):
        readers.messages(spark, subscription="group", **{"kafka.bootstrap.servers": "x:1"})
