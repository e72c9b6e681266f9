"""Hand-made edge rows: null, falsy, NaN, duplicate and malformed input."""

import datetime as dt

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from loomwork.functions import scalars
from loomwork.operators import audit, joins, mapping, quality, reports, routing
from loomwork.operators.quality import Rule
from loomwork.plans import jobs
from loomwork.sources import readers, tables, writers
from loomwork.sources.workspace import fresh_path
from loomwork.streaming import streams



def now():
    return F.lit(dt.datetime(2024, 2, 1, 12)).cast("timestamp_ntz")


MAPPING = "data_schema string, tech_schema string, reconcile_sts string, reconciled_confirm string, update_dt string"


def test_quality_rules(spark):
    rows = [(1, "abx", 5.0), (0, "abx", 10.0), (None, "abx", 0.0), (2, "xab", 5.0), (3, "", None), (4, "abx", float("nan")), (5, "q", 11.0)]
    df = spark.createDataFrame(rows, "k int, s string, v double")
    rules = [Rule("required", "k"), Rule("not_null", "k"), Rule("regex", "s", "ab"), Rule("range", "v", low=0, high=10), Rule("odd", "k"), Rule("required", "absent")]
    got = [(r.k, r._dq_status, r._dq_errors) for r in quality.annotate(df, rules[:-1]).collect()]
    assert got == [
        (1, "PASSED", None),
        (0, "FAILED", ["Missing required field: k"]),
        (None, "FAILED", ["Missing required field: k", "Null value in field: k"]),
        (2, "FAILED", ["Invalid format in field s"]),
        (3, "PASSED", None),
        (4, "PASSED", None),
        (5, "FAILED", ["Invalid format in field s", "Value 11.0 above maximum 10 in field v"]),
    ]
    assert quality.annotate(df, rules).where("_dq_status = 'PASSED'").count() == 0
    passed, failed = quality.split(quality.annotate(df, rules[:-1]))
    assert (passed.count(), failed.count()) == (3, 4)


@pytest.mark.parametrize("n", [0, 6])
def test_counters_are_observed_in_one_pass(spark, n):
    rows = spark.createDataFrame([(k, None if k % 3 else "x") for k in range(n)], "k int, member_number string")
    annotated = quality.annotate(rows, [Rule("required", "k"), Rule("not_null", "member_number")])
    seen = Observation(f"counters-{n}")
    assert quality.observed(annotated, seen).count() == n
    assert seen.get == quality.counters(annotated).first().asDict()


def test_mapping(spark):
    rows = [("segment", "c_mktsegment", "Y", "N", "2024-02-01"), ("c_name", "", "Y", "Y", "2024-02-01"), ("c_nationkey", None, None, None, "2024-02-01"), ("old", "x", "Y", "Y", "2024-01-01"), ("undated", "x", "Y", "Y", None)]
    latest = mapping.latest_snapshot(spark.createDataFrame(rows, MAPPING), "update_dt")
    made = mapping.with_keys(mapping.derived(latest, "data_schema", "tech_schema", "reconcile_sts", "reconciled_confirm"))
    assert dict(mapping.pairs(made, "ongoing")) == {"segment": "c_mktsegment", "c_name": "c_name", "c_nationkey": "c_nationkey", "member_id": "member_number", "member_number": "member_number"}
    assert dict(mapping.pairs(made, "origin"))["segment"] == "segment"
    undated = mapping.latest_snapshot(spark.createDataFrame(rows[-1:], MAPPING), "update_dt")
    assert undated.count() == 1
    empty = mapping.with_keys(mapping.derived(undated.limit(0), "data_schema", "tech_schema", "reconcile_sts", "reconciled_confirm"))
    assert len(mapping.pairs(empty, "ongoing")) == 2
    assert mapping.loaded(spark, "absent_table", data_col="a", tech_col="b", ongoing_flag="c", origin_flag="d").count() == 2
    with pytest.raises(ValueError, match="more than"):
        mapping.pairs(spark.range(1001).select(F.col("id").cast("string").alias("out_col"), F.lit("x").alias("ongoing_in")), "ongoing")


def test_mapping_is_refreshed():
    clock, values = iter([0, 599, 600, 601]), iter("ab")
    refreshed = mapping.Refreshed(lambda: next(values), 600, lambda: next(clock))
    assert [refreshed() for _ in range(4)] == ["a", "a", "b", "b"]


def test_lookup_fallback(spark):
    new = spark.createDataFrame([(1, None, "n"), (2, "n", None), (3, None, None), (0, None, None), (None, None, None)], "id int, a string, b string")
    old = spark.createDataFrame([(1, "e1", 1), (1, "e2", 2), (2, "e", 1), (0, "z", 1), (None, "z", 1)], "id int, a string, at int")
    out = joins.lookup_fallback(new, old, [("id", "id"), ("a", "a"), ("b", "b")], scalars.first_truthy(new, ["nowhere", "id"]), "id", [F.desc("at")])
    got = sorted(out.select("id", "a", "b", "_metadata.enriched").collect(), key=str)
    assert sorted(map(tuple, got), key=str) == sorted([(1, "e2", "n", True), (2, "n", None, True), (3, None, None, False), (0, None, None, False), (None, None, None, False)], key=str)


def test_reconcile_and_backfill(spark):
    member = spark.createDataFrame([(1, "a", "b"), (2, None, "d"), (None, "e", "f")], "k int, x string, y string")
    personas = spark.createDataFrame([(1, "P"), (3, "Q"), (None, "R")], "k int, tx string")
    triples = [("x", "tx", "Y"), ("y", "", "N"), ("k", "k", "Y")]
    got = joins.reconcile(member, personas, triples, "k", now()).select("k", "tx", "y", "reconciliation_batch").collect()
    assert sorted(map(tuple, got), key=str) == sorted([(1, "P", "b", "20240201"), (2, None, "d", "20240201"), (None, "e", "f", "20240201")], key=str)
    twice = personas.unionByName(personas)
    assert joins.reconcile(member, twice, triples, "k", now()).count() == 4
    back = joins.backfill(member, personas, triples, "k", now()).collect()
    assert {(r.k, r.x, r.backfill_timestamp is None) for r in back} == {(1, "P", False), (2, None, True), (None, "e", True)}
    with pytest.raises(Exception, match="more than one source row"):
        joins.backfill(member, twice, triples, "k", now()).collect()


def test_same_snapshot_reconcile_job(spark):
    member = spark.createDataFrame([(1, "own")], "k int, x string")
    personas = spark.createDataFrame([(1, "theirs")], "k int, x string")
    rows = spark.createDataFrame([("x", "", "N", "Y", "2024-02-01")], MAPPING)
    done = jobs.reconcile(member, personas, rows, "k", now(), fresh_path(spark, "job"), "1")
    assert done.personas.first().x == "own" and done.member.first().x == "theirs"
    assert [r.confirmed for r in done.validation.collect()] == [1, 1]
    none = jobs.reconcile(member, personas, rows.withColumn("reconciled_confirm", F.lit("N")), "k", now(), fresh_path(spark, "job"), "1")
    assert none.member.first().x == "own"


def test_windowed_audit_counts_the_null_id_once(spark):
    at = dt.datetime(2024, 1, 1, 1)
    rows = [("a", at, "PASSED"), ("a", at, "FAILED"), (None, at, "PASSED")]
    r = audit.windowed_audit(spark.createDataFrame(rows, "member_number string, timestamp timestamp_ntz, _dq_status string")).first()
    assert (r.records_processed, r.unique_count, r.error_count, round(r.success_rate, 4)) == (3, 2, 1, 0.6667)


def test_metric_rollup(spark):
    rows = [("c", "counter", 1.0, 1), ("c", "counter", 2.0, 2), ("g", "gauge", 5.0, 1), ("g", "gauge", 3.0, 2), ("h", "histogram", 1.0, 1), ("h", "histogram", 3.0, 2), ("t", "timer", 1.0, 1)]
    got = {r.name: r for r in audit.metric_rollup(spark.createDataFrame(rows, "name string, kind string, value double, seq int")).collect()}
    assert got["c"].value == 3 and got["g"].value == 3 and "t" not in got
    assert (got["h"].sample_count, got["h"].sample_sum, got["h"].sample_avg, got["h"].sample_min, got["h"].sample_max) == (2, 4, 2, 1, 3)


def test_freshness(spark):
    minutes = spark.createDataFrame([(61,), (60,), (121,), (None,)], "m int")
    assert [r[0] for r in minutes.select(scalars.freshness_label(F.col("m"))).collect()] == ["WARNING: Check pipeline", "OK", "ALERT: Data stale", "OK"]
    report = spark.createDataFrame([("ALERT: x",), ("WARNING: y",), ("OK",)], "t string")
    assert [r[0] for r in report.select(scalars.overall_status(F.col("t"))).collect()] == ["CRITICAL", "WARNING", "HEALTHY"]
    assert reports.health_row(spark.createDataFrame([], "table_name string, minutes_since_update long, health_status string"), now(), "t", "e").first().overall_status == "HEALTHY"


def test_object_names(spark):
    uris = spark.createDataFrame([("s3://b/p/q.parquet",), ("s3://b",), ("",), (None,), ("/x",)], "u string")
    assert [r[0] for r in uris.select(scalars.object_name(F.col("u"))).collect()] == ["s3:b.p/q.parquet", "s3:b", "s3:unknown", "s3:unknown", "s3:/x"]


def test_minutes_count_boundaries(spark):
    rows = spark.sql("select timestamp_ntz'2024-01-01 00:01:10' a, timestamp_ntz'2024-01-01 00:00:50' b")
    assert rows.select(scalars.minutes_between(F.col("a"), F.col("b"))).first()[0] == 1


def test_notifications(spark):
    payloads = ['{"member_number": "7"}', '{"profileId": "8", "type": "insert"}', '{"member_number": "", "member_id": "9"}', '{"member_number": 0}', '{"x": 1}', "{bad", "", None]
    rows = spark.createDataFrame([(p,) for p in payloads], "value string")
    got = [(r.member_number, r._notification_type) for r in streams.notifications(rows, "value", now()).collect()]
    assert got == [("7", "update"), ("8", "insert"), ("9", "update")]


def test_branches_and_errors(spark):
    df = spark.createDataFrame([(1, None), (2, "bad"), (3, "")], "k int, _error string")
    good, errors = routing.error_routes(df, now())
    assert [r.k for r in good.collect()] == [1, 3] and [r.record.k for r in errors.collect()] == [2]
    with pytest.raises(ValueError, match="1 of 3"):
        routing.error_routes(df, now(), max_share=0.1)
    assert routing.main_branch(df, {"main": "k > 1"}).count() == 2 and routing.main_branch(df, {"other": "k > 1"}).count() == 3
    with pytest.raises(TypeError):
        routing.chained(df, ["no step"])


def test_sources_and_sinks(spark):
    df, path = spark.createDataFrame([(1, "a")], "k int, _m string"), fresh_path(spark, "sink")
    writers.write_table(df, path, "empty")
    with pytest.raises(ValueError, match="holds rows"):
        writers.write_table(df, path, "empty")
    assert readers.files(spark, path).columns == ["k"]
    for wrong in (lambda: readers.files(spark, path, "orc"), lambda: readers.read_source(spark, "ftp"), lambda: readers.scan(spark), lambda: readers.messages(spark), lambda: writers.write_files(df, path, "orc"), lambda: writers.write_table(df, path, "other")):
        with pytest.raises(ValueError):
            wrong()
    with pytest.raises(Exception, match="(?i)avro"):
        readers.files(spark, path, "avro")
    text = fresh_path(spark, "text")
    writers.write_files(spark.createDataFrame([("x",)], "value string"), text, "text")
    assert readers.files(spark, text, "text").first().value == "x"
    assert readers.scan(spark, query="select 1 as one").first().one == 1
    root = fresh_path(spark, "versions")
    first = writers.replaced(df, root, "1", "versioned")
    writers.replaced(first.unionByName(first), root, "2", "versioned")
    assert spark.table("versioned").count() == 2
    # a session that doesn't know the view finds the same version, and never one that isn't finished
    assert writers.current(spark, root).count() == 2
    first.unionByName(first).unionByName(first).write.parquet(f"{root}/data/never-committed")
    assert writers.current(spark, root).count() == 2
    with pytest.raises(ValueError, match="no finished version"):
        writers.current(spark, fresh_path(spark, "none"))
    loaded = writers.bulk_load(spark, tables.latest(spark, root).entry["files"][0]["path"], fresh_path(spark, "staging"), lineage="nosuchscheme://x/y")
    assert loaded.count() == 2


def test_repeated_micro_batch_replaces_itself(spark):
    path = fresh_path(spark, "once")
    for _ in range(2):
        streams.once(spark.range(3), 5, path)
    assert spark.read.parquet(path).count() == 3


def test_enrich_takes_the_latest_row_of_a_key(spark):
    stream = spark.createDataFrame([(1, "a"), (2, "b"), (0, "c"), (None, "d")], "k long, v string")
    dimension = spark.createDataFrame([(1, "old", 1), (1, "new", 2), (2, None, 1), (0, "never", 1)], "d long, v string, at int")
    got = joins.enrich(stream, dimension, "k", "d", ["v"], now(), [F.col("at").desc()])
    assert sorted((r.k or 0, r.v) for r in got.collect()) == [(0, "c"), (0, "d"), (1, "new"), (2, "b")]
    as_text = joins.enrich(stream, dimension.withColumn("d", F.col("d").cast("string")), "k", "d", ["v"], now(), [F.col("at").desc()])
    assert sorted(map(str, as_text.select("k", "v").collect())) == sorted(map(str, got.select("k", "v").collect()))


def _arriving(spark, folder, parts):
    """A stream with one micro-batch for each part of (member_number, hour)."""
    kind = "member_number string, timestamp timestamp, _dq_status string"
    for rows in parts:
        spark.createDataFrame([(k, dt.datetime(2024, 2, 1, hour, 30), "PASSED") for k, hour in rows], kind).coalesce(1).write.mode("append").parquet(folder)
    return spark.readStream.schema(kind).option("maxFilesPerTrigger", 1).parquet(folder)


def test_a_row_behind_the_watermark_is_left_out(spark):
    """A row for the window of 1 o'clock changes nothing once a batch has ended in which that of 5 o'clock was seen, and
    windows that the watermark hasn't passed are not emitted."""
    parts = [[("a", 1), ("b", 1)], [("c", 5)], [("c", 6)], [("d", 1)], [("e", 8)]]
    out = fresh_path(spark, "late")
    streams.to_files(streams.stream_audit(_arriving(spark, fresh_path(spark, "arriving"), parts)), out, fresh_path(spark, "checkpoint")).awaitTermination()
    got = sorted((r.window_start.hour, r.records_processed) for r in spark.read.parquet(out).collect())
    assert got == [(1, 2), (5, 1), (6, 1)]


@pytest.mark.parametrize("exactly_once", [True, False])
def test_fan_out_in_both_modes(spark, exactly_once):
    """Once exactly, a batch that is written again replaces itself; at least once, it is appended again."""
    stream = _arriving(spark, fresh_path(spark, "arriving"), [[("a", 1)], [("b", 2), ("c", 3)]])
    out, failing = fresh_path(spark, "all"), fresh_path(spark, "failing")
    fails = [True]

    def broken(batch, batch_id):
        if batch_id == 1 and fails:
            fails.pop()
            raise ValueError("once")
        return batch

    at = fresh_path(spark, "checkpoint")
    with pytest.raises(Exception, match="once"):
        streams.fan_out(stream, at, {out: lambda b, _: b, failing: broken}, exactly_once).awaitTermination()
    streams.fan_out(stream, at, {out: lambda b, _: b, failing: broken}, exactly_once).awaitTermination()
    keys = sorted(r.member_number for r in spark.read.parquet(out).collect())
    assert keys == ["a", "b", "c"] if exactly_once else keys == ["a", "b", "b", "c", "c"]
    assert spark.read.parquet(failing).count() == 3 and not spark.sparkContext._jsc.getPersistentRDDs()
