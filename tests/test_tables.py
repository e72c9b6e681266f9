"""Versions, conflicts, upserts by buckets and merges that leave files alone."""

import pytest
from pyspark.sql import functions as F

from loomwork.operators import joins
from loomwork.sources import tables

def as_of():
    return F.to_timestamp_ntz(F.lit("2024-01-30 12:00:00"))



def test_versions_go_by_number_not_by_run(spark, tmp_path):
    root = str(tmp_path)
    with pytest.raises(ValueError, match="no finished version"):
        tables.read(spark, root)
    for run in ("9", "10", "1"):
        tables.replace(spark.createDataFrame([(run,)], "run string"), root, run)
        assert tables.read(spark, root).first().run == run
    own = tables.read(spark, root)  # a query may read what it replaces
    tables.replace(own.union(own), root, "again")
    assert tables.read(spark, root).count() == 2 and tables.latest(spark, root).number == 4


def test_of_two_writers_one_fails(spark, tmp_path):
    root, one = str(tmp_path), spark.range(1)
    tables.replace(one, root, "first")
    seen = tables.latest(spark, root)
    tables.replace(one.union(one), root, "a", seen)
    with pytest.raises(tables.Conflict):
        tables.replace(one, root, "b", seen)
    assert tables.read(spark, root).count() == 2
    assert not [p for p in (tmp_path / "_versions").iterdir() if p.name.startswith(".") and not p.name.endswith(".crc")]


def rows(spark, pairs, at=1):
    return spark.createDataFrame([(k, v, at) for k, v in pairs], "k long, v string, at int")


def test_upserts_touch_their_buckets_only(spark, tmp_path):
    root = str(tmp_path)
    order = [F.desc("at")]
    first = tables.upsert(rows(spark, [(k, "old") for k in range(200)]), root, "k", order, "s", 0, buckets=16)
    second = tables.upsert(rows(spark, [(3, "new"), (500, "added"), (3, "older")], 2).withColumn("at", F.when(F.col("v") == "older", 0).otherwise(2)), root, "k", order, "s", 1)
    paths = lambda v: {f["bucket"]: f["path"] for f in v.entry["files"]}
    changed = {b for b, p in paths(second).items() if paths(first).get(b) != p}
    assert 1 <= len(changed) <= 2 and len(paths(second)) == 16
    got = {r.k: r.v for r in tables.read(spark, root).collect()}
    assert got == {k: "old" for k in range(200)} | {3: "new", 500: "added"}
    assert tables.upsert(rows(spark, [(3, "wrong")], 9), root, "k", order, "s", 1) == second  # a repeated batch
    assert tables.upsert(rows(spark, []), root, "k", order) == second
    tables.upsert(rows(spark, [(None, "x")]), root, "k", order)
    assert tables.read(spark, root).count() == 202
    with pytest.raises(ValueError, match="another key"):
        tables.upsert(rows(spark, [(1, "x")]), root, "v", order)


def test_upserts_of_a_stream(spark, tmp_path):
    root, src = str(tmp_path / "t"), str(tmp_path / "src")
    for at in (1, 2):
        rows(spark, [(k, f"v{at}") for k in range(0, 10, at)], at).coalesce(1).write.mode("append").parquet(src)
        stream = spark.readStream.schema("k long, v string, at int").parquet(src)
        tables.upsert_stream(stream, root, "k", [F.desc("at")], "s", str(tmp_path / "c")).awaitTermination()
    assert {r.k: r.v for r in tables.read(spark, root).collect()} == {k: "v2" if k % 2 == 0 else "v1" for k in range(10)}
    assert tables.latest(spark, root).entry["batches"] == {"s": 1}


def test_a_merge_leaves_files_without_a_match_alone(spark, tmp_path):
    root = str(tmp_path)
    member = spark.range(1000).select("id", F.concat(F.lit("m"), "id").alias("name"), F.lit(None).cast("timestamp_ntz").alias("backfill_timestamp"))
    first = tables.cluster(member, root, "id", 10)
    source = spark.createDataFrame([(5, "five"), (7, None), (-3, "none"), (None, "null"), (5000, "far")], "id long, name string")
    columns = [("name", "name", "Y")]
    second, written = tables.merge(root, source, columns, as_of())
    assert written == 1
    before, after = ({f["path"] for f in v.entry["files"]} for v in (first, second))
    assert len(before & after) == 9
    got = tables.read(spark, root)
    want = joins.backfill(member, source, columns, "id", as_of())
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.select(got.columns).collect()), key=str)
    assert sum(f["rows"] for f in second.entry["files"]) == 1000
    assert tables.merge(root, source.where("id = -3"), columns, as_of()) == (second, 0)
    # inside the ranges, but no such key
    tables.merge(root, spark.createDataFrame([(1, "x")], "id long, name string").where("id = 2"), columns, as_of())
    with pytest.raises(Exception, match="more than one source row"):
        tables.merge(root, spark.createDataFrame([(5, "a"), (5, "b")], "id long, name string"), columns, as_of())
    assert tables.latest(spark, root) == second
