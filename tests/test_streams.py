"""The stream job's state: panes, the audit beside the sinks, counters, fresh dimensions."""

from datetime import datetime

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from loomwork.operators import audit, quality
from loomwork.plans import jobs
from loomwork.sources import tables
from loomwork.streaming import panes, streams

ROWS = "member_number string, timestamp timestamp, _dq_status string"


def sent(spark, path, *rows):
    """One more file, and so one more micro-batch."""
    data = [(m, datetime.fromisoformat(f"2024-01-01T{t}:00"), s) for m, t, s in rows]
    spark.createDataFrame(data, ROWS).coalesce(1).write.mode("append").parquet(path)


def source(spark, path):
    return spark.readStream.schema(ROWS).option("maxFilesPerTrigger", 1).parquet(path)


def at(r):
    return (r.window_start.strftime("%H"), r.pane, r.record_count, r.closing)


@pytest.mark.parametrize("early", [0, 3600])
def test_panes_add_up_and_come_once(spark, tmp_path, early):
    src, out, check = (str(tmp_path / x) for x in ("src", "out", "check"))

    def run():
        with panes.state_store(spark):
            streams.to_files(panes.fired(source(spark, src), early=early), out, check).awaitTermination()
        return sorted(at(r) for r in spark.read.parquet(out).collect())

    sent(spark, src, ("a", "10:05", "PASSED"), ("b", "10:10", "PASSED"))
    sent(spark, src, ("a", "10:50", "PASSED"), ("a", "11:01", "FAILED"))
    first = run()
    assert [x for x in first if x[0] == "10"] == ([("10", 0, 2, False), ("10", 1, 1, False), ("10", 2, 0, True)] if early == 0 else [("10", 0, 3, True)])
    sent(spark, src, ("late", "10:59", "PASSED"), ("a", "11:30", "PASSED"))  # 10 has closed
    sent(spark, src, ("a", "13:00", "PASSED"))
    second = run()
    assert second[: len([x for x in first if x[0] == "10"])] == [x for x in first if x[0] == "10"]
    eleven = [x for x in second if x[0] == "11"]
    assert sum(x[2] for x in eleven) == 2 and eleven[-1][-1] and [x[1] for x in eleven] == list(range(len(eleven)))
    assert len(set(second)) == len(second)


def fanned(spark, src, root, check, **more):
    rows = source(spark, src)
    streams.fan_out(rows, check, {f"{root}/plain": lambda b, _: b}, audits={f"{root}/audit": lambda b: b}, **more).awaitTermination()


def test_the_audit_beside_the_sinks_equals_the_batch_audit(spark, tmp_path):
    src, root, check = (str(tmp_path / x) for x in ("src", "root", "check"))
    sent(spark, src, ("a", "10:05", "PASSED"), ("a", "10:06", "FAILED"), (None, "10:07", "PASSED"))
    sent(spark, src, ("a", "10:50", "PASSED"), ("b", "10:51", "PASSED"), ("a", "11:01", "FAILED"))
    fanned(spark, src, root, check)
    sent(spark, src, ("late", "10:59", "PASSED"), ("c", "11:30", "PASSED"))
    sent(spark, src, ("a", "13:00", "PASSED"))
    fanned(spark, src, root, check)
    kept = spark.read.parquet(f"{root}/plain").drop("batch_id").where("member_number is null or member_number <> 'late'")
    want = audit.windowed_audit(kept).where("window_end <= timestamp'2024-01-01 13:00:00'")
    got = spark.read.parquet(f"{root}/audit/closed").select(want.columns)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect())) and got.count() == 2


def test_a_repeated_batch_replaces_its_own_audit(spark, tmp_path):
    root = str(tmp_path)
    batch = lambda *rows: spark.createDataFrame([(m, datetime.fromisoformat(f"2024-01-01T{t}:00"), s) for m, t, s in rows], ROWS)
    steps = [batch(("a", "10:05", "PASSED")), batch(("b", "10:10", "PASSED"), ("a", "12:00", "PASSED")), batch(("z", "14:00", "PASSED"))]
    for number in (0, 1, 1, 2, 2):
        streams.audit_batch(steps[number], number, root)
    got = {r.window_start.hour: (r.records_processed, r.unique_count) for r in spark.read.parquet(f"{root}/closed").collect()}
    assert got == {10: (2, 2), 12: (1, 1)}
    streams.audit_batch(batch(), 3, root)
    assert spark.read.parquet(f"{root}/closed").count() == 2


def test_stream_counters_add_up_to_the_batches(spark, tmp_path):
    src, out, path = (str(tmp_path / x) for x in ("src", "out", "counts"))
    for rows in ([("1", "10:00", "x"), (None, "10:01", "x")], [("", "10:02", "x"), ("2", "10:03", "x"), ("3", "10:04", "x")]):
        sent(spark, src, *rows)
    rules = (quality.Rule("required", "member_number"), quality.Rule("not_null", "member_number"))
    rows = quality.annotate(source(spark, src).drop("_dq_status"), rules)
    with streams.counted(spark, "quality", path) as listener:
        streams.to_files(quality.observed(rows, "quality"), out, str(tmp_path / "check")).awaitTermination()
    total = streams.pipeline_counters(spark, path, len(listener.failed)).first().asDict()
    plain = quality.counters(quality.annotate(spark.read.parquet(src).drop("_dq_status"), rules)).first().asDict()
    assert total == {"batches": 2, "failed_queries": 0, **plain}
    assert plain["records_processed"] == 5 and plain["dq_errors"] == 3
    broken = source(spark, src).withColumn("x", F.raise_error(F.lit("no")))
    with streams.counted(spark, "quality", path) as listener, pytest.raises(Exception, match="no"):
        streams.to_files(broken, f"{out}2", str(tmp_path / "check2")).awaitTermination()
    assert len(listener.failed) == 1


def test_a_batch_sees_the_dimension_of_its_time(spark, tmp_path):
    src, dim = str(tmp_path / "src"), str(tmp_path / "dim")
    outs = [str(tmp_path / x) for x in ("staging", "refined", "trace", "audit")]
    named = lambda *rows: spark.createDataFrame(rows, "k string, name string, at int")
    run = lambda: jobs.stream(source(spark, src).drop("_dq_status"), lambda: tables.read(spark, dim), ["name"], "k", [F.desc("at")], "long", *outs, str(tmp_path / "check"), None, F.current_timestamp(), "timestamp").awaitTermination()
    tables.replace(named(("1", "old", 1), ("1", "older", 0)), dim, "a")
    sent(spark, src, ("1", "10:00", "x"), ("9", "10:01", "x"))
    run()
    tables.replace(named(("1", "new", 2)), dim, "b")
    sent(spark, src, ("1", "10:02", "x"))
    run()
    got = spark.read.parquet(outs[1])
    assert sorted((r.member_number, r.name) for r in got.collect()) == sorted([("1", "old"), ("9", None), ("1", "new")], key=str)


def test_a_second_dimension_row_of_a_key_raises_without_an_order(spark):
    messages = spark.createDataFrame([("1",)], "member_number string")
    twice = spark.createDataFrame([("1", "a"), ("1", "b"), (None, "c"), (None, "d")], "k string, name string")
    with pytest.raises(Exception, match="more than one row for k 1"):
        jobs.stream_rows(messages, twice, ["name"], "k", F.current_timestamp()).collect()
    one = jobs.stream_rows(messages, twice.where("name <> 'b'"), ["name"], "k", F.current_timestamp()).first()
    assert one.name == "a"


def test_observed_in_a_batch(spark):
    seen = Observation("q")
    quality.observed(quality.annotate(spark.createDataFrame([("1",), (None,)], "member_number string")), seen).count()
    assert seen.get["records_processed"] == 2
