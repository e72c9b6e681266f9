"""Own aggregates, the digest tree, and the reconciliation as a run that can be repeated."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from loomwork.operators import aggregates, joins
from loomwork.plans import jobs, stateful
from loomwork.plans import queries as plans
from loomwork.sources import tables

SF = "/root/testdata/sf0.001"


def longest():
    """A local class, which workers get by value."""

    class Longest:
        """The longest text of a key, and how many there were."""

        def create(self):
            return 0, ""

        def add(self, state, rows):
            return self.merge(state, (rows.num_rows, max((t for t in rows["t"].to_pylist() if t), key=len, default="")))

        def merge(self, state, other):
            return state[0] + other[0], max(state[1], other[1], key=len)

        def extract(self, state):
            return {"n": state[0], "longest": state[1]}

    return Longest()


@pytest.mark.parametrize("keys", [1, 10_000])
def test_an_aggregate_of_ones_own(spark, monkeypatch, keys):
    monkeypatch.setattr(aggregates, "KEYS", keys)
    rnd = random.Random(1)
    data = [(rnd.choice(["a", "b", None]), rnd.randrange(3), "x" * rnd.randrange(9)) for _ in range(500)] + [("c", 1, None)]
    df = spark.createDataFrame(data, "k string, j int, t string").repartition(5)
    got = {(r.k, r.j): (r.n, len(r.longest)) for r in aggregates.user_aggregate(df, ["k", "j"], ["t"], longest(), "n long, longest string").collect()}
    count = Counter((k, j) for k, j, _ in data)
    assert got == {key: (n, max(len(t or "") for k, j, t in data if (k, j) == key)) for key, n in count.items()}
    assert aggregates.user_aggregate(df.limit(0), ["k"], ["t"], longest(), "n long, longest string").count() == 0


def test_a_busy_key_is_one_state_a_task(spark):
    df = spark.range(0, 20_000, 1, 4).select(F.lit("hot").alias("k"), F.col("id").cast("string").alias("t"))
    out = aggregates.user_aggregate(df, ["k"], ["t"], longest(), "n long, longest string")
    assert out.first().n == 20_000
    assert aggregates.partial_states(df, ["k"], ["t"], longest()).count() == 4


def test_the_digest_tree_compares_only_what_differs(spark):
    fields = ["v"]
    before = spark.range(3000).select("id", F.concat(F.lit("v"), "id").alias("v"))
    after = before.where("id <> 17").withColumn("v", F.when(F.col("id") == 1234, "other").otherwise(F.col("v"))).unionByName(spark.createDataFrame([(9999, "new")], "id long, v string"))
    known = joins.digests(before, "id", fields), joins.digests(after, "id", fields)
    leaves = {r.leaf for r in joins.differing(*known).collect()}
    want = {r[0] for r in spark.createDataFrame([(17,), (1234,), (9999,)], "id long").select(joins._leaf(F.col("id"))).collect()}
    assert leaves == want
    for given in (None, known):
        got = joins.row_diff_by_digest(before, after, "id", fields, given)
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, joins.row_diff(before, after, "id", fields).collect()))
    assert joins.differing(known[0], known[0]).isEmpty()
    none = before.limit(0)
    assert {r.change for r in joins.row_diff_by_digest(before, none, "id", fields).collect()} == {"removed"}
    assert joins.row_diff_by_digest(none, none, "id", fields).isEmpty()
    # a value moved from one key to another, and a repeated row, change digests
    swapped = before.withColumn("v", F.when(F.col("id") == 1, "v2").when(F.col("id") == 2, "v1").otherwise(F.col("v")))
    assert joins.differing(known[0], joins.digests(swapped, "id", fields)).count() == 2
    assert joins.differing(known[0], joins.digests(before.unionByName(before.where("id = 5")), "id", fields)).count() == 1


MAPPING = "data_table string, data_schema string, tech_schema string, reconcile_sts string, reconciled_confirm string, update_dt string"


def as_of(day=30):
    return F.to_timestamp_ntz(F.lit(f"2024-01-{day} 12:00:00"))


def made(spark, tmp_path, confirmed):
    root = str(tmp_path / "root")
    spark.createDataFrame([("m", "name", "tech", "Y", confirmed, "2024-01-02"), ("m", "old", "", "Y", confirmed, "2024-01-01")], MAPPING).write.parquet(str(tmp_path / "mapping"))
    spark.createDataFrame([(1, "a"), (2, None), (3, "c")], "id long, name string").coalesce(1).write.parquet(str(tmp_path / "member"))
    tables.replace(spark.createDataFrame([(1, "p"), (2, "q")], "id long, tech string"), f"{root}/personas", "before")
    return root, (spark, "r1", root, str(tmp_path / "mapping"), str(tmp_path / "member"), "m", "id")


def versions(spark, root):
    return {name: tables.latest(spark, f"{root}/{name}").number for name in ("mapping", "member", "personas", "lineage", "log")}


@pytest.mark.parametrize("confirmed", ["Y", "N"])
def test_a_repeated_run_changes_nothing(spark, tmp_path, confirmed):
    root, args = made(spark, tmp_path, confirmed)
    jobs.reconcile_run(*args, as_of())
    first = versions(spark, root)
    assert first == {"mapping": 1, "member": 2 if confirmed == "Y" else 1, "personas": 2, "lineage": 1, "log": 1}
    jobs.reconcile_run(*args, as_of(31))
    assert versions(spark, root) == first
    assert {(r.id, r.tech) for r in tables.read(spark, f"{root}/personas").collect()} == {(1, "p"), (2, "q"), (3, "c")}
    assert {r.id: r.name for r in tables.read(spark, f"{root}/member").collect()} == ({1: "p", 2: "q", 3: "c"} if confirmed == "Y" else {1: "a", 2: None, 3: "c"})
    log = {r.table_name: r for r in tables.read(spark, f"{root}/log").collect()}
    assert log["personas"].record_count == 3 and log["member"].total_columns == 1 and log["member"].confirmed == (1 if confirmed == "Y" else 0)
    assert (log["member"].last_reconciled is None) == (confirmed == "N")
    # the next run reads what this one made, and adds to the log
    jobs.reconcile_run(spark, "r2", *args[2:], as_of(31))
    assert tables.read(spark, f"{root}/log").count() == 4


@pytest.mark.parametrize("lost", range(6))
def test_a_run_goes_on_where_it_was_cut_off(spark, tmp_path, monkeypatch, lost):
    """The ledger's note of one step is lost after the step was done."""
    root, args = made(spark, tmp_path, "Y")
    plain, calls = tables.commit, []

    def failing(session, path, *rest):
        if "/ledger/" in path:
            calls.append(path)
            if len(calls) == lost + 1:
                raise OSError("lost")
        return plain(session, path, *rest)

    monkeypatch.setattr(tables, "commit", failing)
    with pytest.raises(OSError, match="lost"):
        jobs.reconcile_run(*args, as_of())
    jobs.reconcile_run(*args, as_of())
    assert versions(spark, root) == {"mapping": 1, "member": 2, "personas": 2, "lineage": 1, "log": 1}
    assert tables.read(spark, f"{root}/log").count() == 2


def _few_rows_a_file(monkeypatch, rows=100):
    monkeypatch.setattr(stateful, "ROWS", rows)
    arrived, before = [], set()
    arrive = stateful._arrive

    def seen(part, path, files):
        arrive(part, path, files)
        new = set(part.sparkSession.read.schema(part.schema).parquet(path).inputFiles()) - before
        before.update(new)
        arrived.append((files, len(new), max(part.sparkSession.read.parquet(f).count() for f in new)))

    monkeypatch.setattr(stateful, "_arrive", seen)
    return arrived


@pytest.mark.parametrize("name", ["j2_fresh_dimension", "w7_delivery", "m5_stream_refresh", "a7_stream_counters", "w4_late_rows"])
def test_events_arrive_in_files_of_bounded_rows(spark, monkeypatch, name):
    """No task writes all rows of a part, and the files of a part are still one micro-batch."""
    want = plans.QUERIES[name](spark, SF).collect()
    arrived = _few_rows_a_file(monkeypatch)
    got = plans.QUERIES[name](spark, SF).collect()
    assert sorted(map(repr, got)) == sorted(map(repr, want))
    assert arrived and all(files > 1 and new == files and rows <= 125 for files, new, rows in arrived)


def test_a_part_of_fewer_rows_than_files_still_has_all_its_files(spark, tmp_path):
    part = spark.range(2)
    stateful._arrive(part, str(tmp_path / "a"), 5)
    stateful._arrive(part.limit(0), str(tmp_path / "a"), 5)
    read = spark.read.schema("id long").parquet(str(tmp_path / "a"))
    assert len(read.inputFiles()) == 10 and read.count() == 2
