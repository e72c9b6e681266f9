"""Registered queries of versioned tables, topics and streams of several micro-batches, each with its DuckDB twin."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomwork.operators import aggregates, joins, mapping, quality, reports, routing
from loomwork.plans import jobs
from loomwork.plans.queries import (
    _ANNOTATED,
    _AUDIT,
    _BACKFILLED,
    _EXISTING,
    _INCOMING,
    _PERSONAS,
    _RULES,
    _STREAMED,
    AS_OF,
    _audited,
    _existing,
    _incoming,
    _personas,
    _ran,
    _stream,
    _streamed,
    _table,
    as_of,
    registered,
)
from loomwork.sources import readers, tables, topics, writers
from loomwork.sources.workspace import exists, fresh_path
from loomwork.streaming import panes, streams

PARTS = 4
#: Rows of an arriving file, about: a file is written by one task, and its rows are mostly read by one.
ROWS = 250_000


def _parts_of_events(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """The events in four parts, in the order of their ids, as they come in one after the other."""
    events = _table(spark, sf_dir, "events")
    last = events.agg(F.max("event_id")).first()[0]
    part = F.floor(F.col("event_id") * PARTS / (last + 1))
    return [events.where(part == i) for i in range(PARTS)]


_PART = f"floor(event_id * {PARTS} / (SELECT max(event_id) + 1 FROM events))"


def _files_of_part(spark: SparkSession, sf_dir: str) -> int:
    """The files that each part of the events arrives in, which are a micro-batch: their number grows with the events."""
    return max(1, math.ceil(_table(spark, sf_dir, "events").count() / PARTS / ROWS))


def _arrive(part: DataFrame, path: str, files: int) -> None:
    """``part`` as just so many new files, written side by side. Tasks without rows write none, so empty ones are added."""
    there = lambda: len(part.sparkSession.read.schema(part.schema).parquet(path).inputFiles()) if exists(part.sparkSession, path) else 0
    wanted = there() + files
    part.repartition(files).write.mode("append").parquet(path)
    for _ in range(wanted - there()):
        part.limit(0).coalesce(1).write.mode("append").parquet(path)


def _in_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stream of the events in four micro-batches."""
    path, files = fresh_path(spark, "arriving"), _files_of_part(spark, sf_dir)
    for part in _parts_of_events(spark, sf_dir):
        _arrive(part, path, files)
    schema = _table(spark, sf_dir, "events").schema
    return readers.messages(spark, topic=path, schema=schema, format="parquet", maxFilesPerTrigger=str(files)).withColumn("ts", F.col("ts").cast("timestamp"))


def _as_messages(events: DataFrame) -> DataFrame:
    attributes = F.create_map(F.lit("kind"), "event_type", F.lit("user"), F.col("user_id").cast("string"))
    return events.select(F.col("event_id").cast("string").alias("value"), attributes.alias("attributes"), F.col("ts").cast("timestamp").alias("publish_time"))


@registered(f"SELECT event_id::VARCHAR AS value, event_type AS kind, user_id::VARCHAR AS member, {_PART}::BIGINT + 1 AS commit FROM events WHERE ts >= TIMESTAMP '2024-01-10 00:00:00' AND {_PART} <> 1")
def x4_connector(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A topic written and read through the data source; filters on time and commit pass over segments."""
    root = fresh_path(spark, "messages")
    for part in _parts_of_events(spark, sf_dir):
        topics.publish(_as_messages(part), root, "events")
    rows = topics.read_topic(spark, root, "events", with_attributes=True).where("publish_time >= timestamp'2024-01-10 00:00:00' and commit <> 2")
    return rows.select("value", F.col("attributes")["kind"].alias("kind"), F.col("attributes")["user"].alias("member"), "commit")


@registered(f"SELECT 'all' AS subscription, event_id::VARCHAR AS value FROM events UNION ALL SELECT 'late', event_id::VARCHAR FROM events WHERE {_PART} > 0")
def s8_subscriptions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two subscriptions of one topic, each read by two queries one after the other, the second without a checkpoint."""
    root, out = fresh_path(spark, "messages"), fresh_path(spark, "received")
    parts = [_as_messages(p) for p in _parts_of_events(spark, sf_dir)]

    def received(name: str) -> None:
        rows = readers.messages(spark, subscription=name, root=root, with_attributes=True).select("value")
        topics.finished(streams.to_files(rows, f"{out}/{name}/{fresh_path(spark, 'q').rpartition('-')[2]}", fresh_path(spark, "checkpoint")), root, name)

    topics.publish(parts[0], root, "events")
    topics.subscribe(root, "events", "all")
    topics.subscribe(root, "events", "late", from_start=False)
    topics.publish(parts[1], root, "events")
    received("all")
    for part in parts[2:]:
        topics.publish(part, root, "events")
    for name in ("all", "late"):
        received(name)
    read = [spark.read.schema("value string").option("recursiveFileLookup", True).parquet(f"{out}/{name}").select(F.lit(name).alias("subscription"), "value") for name in ("all", "late")]
    return reports.union_all(read)


@registered("SELECT event_id::VARCHAR AS value, event_type AS kind FROM events WHERE event_type <> 'view'")
def k6_publish_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stream of one topic, published to another in micro-batches."""
    root = fresh_path(spark, "messages")
    check = fresh_path(spark, "checkpoint")
    for part in _parts_of_events(spark, sf_dir):
        topics.publish(_as_messages(part), root, "in")
        rows = topics.stream_topic(spark, root, "in", with_attributes=True).where("attributes['kind'] <> 'view'")
        topics.publish_stream(rows.select("value", "attributes", "publish_time"), root, "out", "copy", check).awaitTermination()
    return topics.read_topic(spark, root, "out", with_attributes=True).select("value", F.col("attributes")["kind"].alias("kind"))


@registered("SELECT time_bucket(INTERVAL 1 HOUR, ts) AS window_start, count(*) AS record_count, 1 AS closings FROM events GROUP BY 1 HAVING time_bucket(INTERVAL 1 HOUR, window_start) + INTERVAL 1 HOUR <= (SELECT max(ts) FROM events)")
def w2_panes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Early and closing panes of the windows that have closed; they add up to the windows' rows."""
    out = fresh_path(spark, "panes")
    rows = _in_batches(spark, sf_dir).select(F.col("ts").alias("timestamp"))
    with panes.state_store(spark):
        _ran(streams.to_files(panes.fired(rows, early=0), out, fresh_path(spark, "checkpoint")))
    sums = spark.read.parquet(out).groupBy("window_start").agg(F.sum("record_count").alias("record_count"), F.count_if("closing").cast("int").alias("closings"))
    return sums.where("closings > 0").withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))


_AUDITED_STREAM = _AUDIT.replace("FROM events", f"FROM (SELECT s.event_id, s.member_number AS user_id, e.ts, e.event_type FROM ({_STREAMED}) s JOIN events e ON s.event_id = e.event_id)").replace("event_type = 'error'", "event_type = 'none'")


@registered(f"SELECT * FROM ({_AUDITED_STREAM}) WHERE window_end <= (SELECT max(e.ts) FROM events e WHERE event_id % 4 <> 3 AND (event_id % 4 = 2 OR user_id <> 0))")
def z2_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The hourly audit that the stream job keeps beside its sinks, of the windows that have closed."""
    rows = spark.read.parquet(_streamed(spark, sf_dir, "mid")[3]).drop("batch_id")
    return rows.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("window_start", "window_end", "first_seen", "last_seen")})


@registered(_STREAMED)
def z2_refined(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(_streamed(spark, sf_dir, "mid")[1]).select("event_id", "member_number", "c_name")


@registered(f"SELECT * FROM ({_AUDIT}) WHERE window_end <= (SELECT max(ts) FROM events)")
def w6_audit_in_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One read of a stream in four micro-batches, into a sink and the audit, whose counts are merged across batches."""
    out, root = fresh_path(spark, "plain"), fresh_path(spark, "audit")
    _ran(streams.fan_out(_audited(_in_batches(spark, sf_dir)), fresh_path(spark, "checkpoint"), {out: lambda b, _: b}, audits={root: lambda b: b}))
    rows = spark.read.parquet(f"{root}/closed").drop("batch_id")
    return rows.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("window_start", "window_end", "first_seen", "last_seen")})


@registered("SELECT 4::BIGINT AS batches, count(*) AS records_processed, count(*) FILTER (user_id = 0) + count(*) FILTER (value > 90) AS dq_errors, count(*) FILTER (user_id <> 0 AND value <= 90) AS dq_passed, 0::BIGINT AS null_values, 0::BIGINT AS failed_queries FROM events")
def a7_stream_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The counters of each micro-batch, taken by a listener as its rows pass, added up."""
    rules = (quality.Rule("required", "user_id"), quality.Rule("range", "value", high=90))
    rows = quality.observed(quality.annotate(_in_batches(spark, sf_dir), rules), "quality", ["user_id"])
    path = fresh_path(spark, "counters")
    with streams.counted(spark, "quality", path) as listener:
        _ran(streams.to_files(rows, fresh_path(spark, "annotated"), fresh_path(spark, "checkpoint")))
    return streams.pipeline_counters(spark, path, len(listener.failed))


@registered(f"SELECT event_id, CASE WHEN {_PART} < 2 THEN 'old ' ELSE 'new ' END || c_name AS c_name FROM events JOIN customer ON user_id = c_custkey WHERE user_id <> 0")
def j2_fresh_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stream job before and after its dimension got a new version, with two rows a key in each."""
    root, path, check = (fresh_path(spark, name) for name in ("dimension", "arriving", "checkpoint"))
    outs = [fresh_path(spark, name) for name in ("staging", "refined", "trace", "audit")]
    customer, parts, files = _table(spark, sf_dir, "customer"), _parts_of_events(spark, sf_dir), _files_of_part(spark, sf_dir)
    for version, some in (("old ", parts[:2]), ("new ", parts[2:])):
        named = customer.select(F.col("c_custkey").cast("string").alias("key"), F.concat(F.lit(version), "c_name").alias("c_name"), F.lit(2).alias("at"))
        tables.replace(named.unionByName(named.withColumns({"c_name": F.lit("stale"), "at": F.lit(1)})), root, version.strip())
        for part in some:
            _arrive(part.select("event_id", F.col("user_id").cast("string").alias("member_number"), "ts"), path, files)
        rows = readers.messages(spark, topic=path, schema="event_id long, member_number string, ts timestamp_ntz", format="parquet", maxFilesPerTrigger=str(files))
        rows = rows.withColumn("ts", F.col("ts").cast("timestamp")).where("member_number <> '0'")
        _ran(jobs.stream(rows, lambda: tables.read(spark, root), ["c_name"], "key", [F.desc("at")], "long", *outs, check, None, as_of(), "ts"))
    return spark.read.parquet(outs[1]).where("c_name is not null").select("event_id", "c_name")


@registered(f"SELECT event_id, CASE WHEN {_PART} < 2 THEN user_id ELSE event_id END AS member FROM events")
def m5_stream_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four micro-batches of a stream; the mapping is read anew with the third, by a clock that each batch moves on."""
    clock, versions = iter((0.0, 300.0, 700.0, 900.0)), iter(([("event_id", "event_id"), ("member", "user_id")], [("event_id", "event_id"), ("member", "event_id")]))
    columns = mapping.Refreshed(lambda: next(versions), 600, lambda: next(clock))
    out = fresh_path(spark, "mapped")
    _ran(streams.fan_out(_in_batches(spark, sf_dir), fresh_path(spark, "checkpoint"), {out: lambda b, _: mapping.map_columns(b, columns())}))
    return spark.read.parquet(out).select("event_id", "member")


@registered("SELECT user_id, max(event_id) AS event_id, arg_max(event_type, event_id) AS event_type FROM events GROUP BY user_id")
def k7_stream_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last event of each user, kept in a table of key buckets by a stream."""
    root = fresh_path(spark, "last-events")
    rows = _in_batches(spark, sf_dir).select("user_id", "event_id", "event_type")
    _ran(tables.upsert_stream(rows, root, "user_id", [F.desc("event_id")], "events", fresh_path(spark, "checkpoint")))
    return tables.read(spark, root)


@registered("SELECT c_custkey, c_name, '10' AS run FROM customer WHERE c_custkey % 2 = 0")
def k8_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table replaced from itself, by runs whose names are in no order; a writer that read an older version fails."""
    root, rows = fresh_path(spark, "versions"), _table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    first = tables.replace(rows.withColumn("run", F.lit("9")), root, "9")
    even = tables.read(spark, root).where("c_custkey % 2 = 0").withColumn("run", F.lit("10"))
    tables.replace(even, root, "10", first)
    try:
        tables.replace(rows.withColumn("run", F.lit("2")), root, "2", first)
    except tables.Conflict:
        return writers.current(spark, root)
    raise AssertionError("a lost update")


_SOME = f"(SELECT * FROM ({_PERSONAS}) WHERE c_custkey < 400)"


@registered(_BACKFILLED.replace(f"({_PERSONAS})", _SOME))
def k9_pruned_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The merge of a few keys into a table clustered by key, which writes the files with a match anew."""
    root = fresh_path(spark, "clustered")
    member = _table(spark, sf_dir, "customer").withColumn("backfill_timestamp", F.lit(None).cast("timestamp_ntz"))
    tables.cluster(member, root, "c_custkey", 16)
    columns = [("c_mktsegment", "segment", "Y"), ("c_nationkey", "", "Y"), ("c_acctbal", "", "N")]
    tables.merge(root, _personas(spark, sf_dir).where("c_custkey < 400"), columns, as_of())
    return tables.read(spark, root)


@registered("SELECT c_custkey, CASE WHEN c_custkey % 10 = 1 THEN 'removed' WHEN c_custkey % 10 = 2 THEN 'added' WHEN c_custkey % 10 = 3 THEN 'changed' ELSE 'same' END AS change FROM customer")
def j8_digest_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment")
    after = rows.where("c_custkey % 10 <> 1").withColumn("c_name", F.when(F.col("c_custkey") % 10 != 3, F.col("c_name")))
    return joins.row_diff_by_digest(rows.where("c_custkey % 10 <> 2"), after, "c_custkey", ["c_mktsegment", "c_name"])


@registered(_AUDIT)
def x3_user_aggregate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The windowed audit as an aggregate of one's own."""
    rows = _audited(_table(spark, sf_dir, "events")).withColumn("w", F.window("timestamp", "1 hour"))
    rows = rows.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "member_number", "timestamp", "_dq_status")
    return aggregates.user_aggregate(rows, ["window_start", "window_end"], ["member_number", "timestamp", "_dq_status"], aggregates.WindowAudit(), aggregates.WindowAudit.SCHEMA)


_MAPPED = [
    ("members", "c_mktsegment", "segment", "Y", "Y", "2024-02-01"),
    ("members", "c_acctbal", "", "N", "N", "2024-02-01"),
    ("members", "c_nationkey", None, None, "Y", "2024-01-01"),
    ("others", "c_name", "c_name", "N", None, "2024-02-01"),
]


def _reconciled(spark: SparkSession, sf_dir: str) -> str:
    """The folder of a run that was cut off behind its first steps, went on, and was then called once more."""
    root, mapped = fresh_path(spark, "reconciled"), fresh_path(spark, "mapping")
    spark.createDataFrame(_MAPPED, "data_table string, data_schema string, tech_schema string, reconcile_sts string, reconciled_confirm string, update_dt string").write.parquet(mapped)
    tables.replace(_personas(spark, sf_dir), f"{root}/personas", "before")
    args = (spark, "20240130", root, mapped, f"{sf_dir}/customer.parquet", "members", "c_custkey")
    try:
        jobs.reconcile_run(*args, F.raise_error(F.lit("cut off")).cast("timestamp_ntz"))
    except Exception as e:
        if "cut off" not in str(e):
            raise
    for _ in range(2):
        jobs.reconcile_run(*args, as_of())
    return root


@registered(f"SELECT o.c_custkey, o.c_acctbal, coalesce(n.segment, o.c_mktsegment) AS segment, o.c_name, o.c_nationkey, TIMESTAMP '{AS_OF}' AS reconciled_timestamp, '20240130' AS reconciliation_batch FROM customer o LEFT JOIN ({_PERSONAS}) n ON o.c_custkey = n.c_custkey")
def z4_personas(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.read(spark, f"{_reconciled(spark, sf_dir)}/personas")


@registered(_BACKFILLED)
def z4_member(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.read(spark, f"{_reconciled(spark, sf_dir)}/member")


@registered(f"SELECT 'reconcile' AS process, '20240130' AS run, 'customer.parquet' AS source, 'table:member' AS target_fqn, TIMESTAMP '{AS_OF}' AS end_time")
def z4_lineage(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = tables.read(spark, f"{_reconciled(spark, sf_dir)}/lineage")
    return rows.select("process", "run", F.regexp_extract("source_fqn", "customer.parquet", 0).alias("source"), "target_fqn", "end_time").distinct()


@registered(
    f"""SELECT t.*, 2::BIGINT AS total_columns, 1::BIGINT AS reconciling, 1::BIGINT AS confirmed, TIMESTAMP '{AS_OF}' AS validation_timestamp FROM (
 SELECT 'personas' AS table_name, count(*) AS record_count, TIMESTAMP '{AS_OF}' AS last_reconciled FROM customer
 UNION ALL SELECT 'member', count(*), (SELECT max(backfill_timestamp) FROM ({_BACKFILLED})) FROM customer) t"""
)
def z4_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.read(spark, f"{_reconciled(spark, sf_dir)}/log")


_DAY = "c_custkey % 3 = 0"
_ORIGIN = [("member_id", "c_custkey"), ("segment", "c_mktsegment"), ("nation", "c_nationkey")]


def _day_batch(spark: SparkSession, sf_dir: str) -> jobs.Staged:
    """The batch job on the day's rows of a source that is partitioned by its day of ingestion."""
    path = fresh_path(spark, "by-day")
    day = F.when(F.expr(_DAY), F.to_date(as_of())).otherwise(F.date_sub(F.to_date(as_of()), 1))
    _incoming(spark, sf_dir).withColumn("ingest_date", day).write.partitionBy("ingest_date").parquet(path)
    source = readers.partition_scan(readers.files(spark, path), as_of=as_of()).drop("ingest_date")
    old = _table(spark, sf_dir, "customer").where("c_custkey % 2 = 0").withColumn("c_mktsegment", F.concat(F.lit("old "), "c_mktsegment"))
    return jobs.batch_short(source, _ORIGIN[:2], _ORIGIN, _existing(spark, sf_dir), old, ["c_custkey"], "c_custkey", [F.col("c_acctbal")], as_of(), _RULES)


@registered(f"SELECT n.c_custkey AS member_id, coalesce(n.c_mktsegment, e.c_mktsegment) AS segment, n.c_nationkey AS nation, e.c_custkey IS NOT NULL AS enriched FROM ({_INCOMING}) n LEFT JOIN (SELECT c_custkey, 'old ' || c_mktsegment AS c_mktsegment FROM customer WHERE c_custkey % 2 = 0) e ON nullif(n.c_custkey, 0) = e.c_custkey WHERE n.{_DAY}")
def z1_origin(spark: SparkSession, sf_dir: str) -> DataFrame:
    staged = _day_batch(spark, sf_dir)
    return routing.without_metadata(staged.origin.withColumn("enriched", F.col("_metadata.enriched")))


@registered(f"SELECT n.c_custkey AS member_id, coalesce(n.c_mktsegment, e.c_mktsegment) AS segment, e.c_custkey IS NOT NULL AS enriched FROM ({_INCOMING}) n LEFT JOIN ({_EXISTING}) e ON nullif(n.c_custkey, 0) = e.c_custkey WHERE n.{_DAY}")
def z1_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    return routing.without_metadata(_day_batch(spark, sf_dir).ongoing.withColumn("enriched", F.col("_metadata.enriched")))


@registered(
    f"""WITH t AS (SELECT max(e.ts) AS last_ingested FROM ({_STREAMED}) s JOIN events e ON s.event_id = e.event_id WHERE e.ts::DATE = DATE '2024-01-30'),
 m AS (SELECT *, date_diff('minute', last_ingested, TIMESTAMP '{AS_OF}')::BIGINT AS n FROM t)
 SELECT 'refined' AS table_name, last_ingested, n AS minutes_since_update, CASE WHEN n > 120 THEN 'ALERT: Data stale' WHEN n > 60 THEN 'WARNING: Check pipeline' ELSE 'OK' END AS health_status FROM m"""
)
def w8_stream_health(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Freshness of what the stream job wrote."""
    refined = spark.read.parquet(_streamed(spark, sf_dir, "long")[1]).withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    return reports.freshness_row(refined, "refined", "ts", as_of())


@registered("SELECT event_id, copies FROM (SELECT event_id, 1 AS copies FROM events)")
def w7_delivery(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exactly once: a batch whose second sink fails is delivered again and stands once in the first."""
    out, failing, check, path = (fresh_path(spark, name) for name in ("out", "failing", "checkpoint", "arriving"))
    _arrive(_table(spark, sf_dir, "events"), path, PARTS * _files_of_part(spark, sf_dir))
    rows = readers.messages(spark, topic=path, schema=_table(spark, sf_dir, "events").schema, format="parquet").select("event_id")

    def broken(batch: DataFrame, _: int) -> DataFrame:
        return batch.withColumn("x", F.raise_error(F.lit("sink is down")))

    try:
        _ran(streams.fan_out(rows, check, {out: lambda b, _: b, failing: broken}))
    except Exception as e:
        if "sink is down" not in str(e):
            raise
    _ran(streams.fan_out(rows, check, {out: lambda b, _: b, failing: lambda b, _: b}))
    return spark.read.parquet(out).groupBy("event_id").agg(F.count("*").cast("int").alias("copies"))


@registered(f"SELECT event_id FROM events WHERE {_PART} >= 2")
def w4_late_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Half of the events, the same rows a year too late, and the other half: late rows go when the watermark has passed."""
    parts = [p.select("event_id", "ts") for p in _parts_of_events(spark, sf_dir)]
    path, out, files = fresh_path(spark, "arriving"), fresh_path(spark, "kept"), _files_of_part(spark, sf_dir)
    late = parts[2].select((-F.col("event_id") - 1).alias("event_id"), (F.col("ts") - F.expr("interval 400 days")).alias("ts"))
    for part in (parts[2], parts[2].limit(0), late, parts[3]):
        _arrive(part, path, files)
    rows = readers.messages(spark, topic=path, schema="event_id long, ts timestamp_ntz", format="parquet", maxFilesPerTrigger=str(files)).withColumn("ts", F.col("ts").cast("timestamp"))
    _ran(streams.to_files(readers.deduplicated(rows, "event_id", "ts", "1 minute").select("event_id"), out, fresh_path(spark, "checkpoint")))
    return spark.read.parquet(out)


@registered("SELECT c_custkey, c_name, 'table' AS way FROM customer UNION ALL SELECT c_custkey, c_name, 'query' FROM customer WHERE c_acctbal > 0")
def s1_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table by name and dataset, and a query, which wins over the name."""
    name = f"scan_{fresh_path(spark, 's').rpartition('-')[2]}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{fresh_path(spark, name)}'")
    _table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal").write.saveAsTable(f"{name}.customer")
    by_name = readers.scan(spark, "customer", dataset=name)
    by_query = readers.scan(spark, "customer", f"SELECT * FROM {name}.customer WHERE c_acctbal > 0", name)
    return reports.union_all([df.select("c_custkey", "c_name", F.lit(way).alias("way")) for df, way in ((by_name, "table"), (by_query, "query"))])


@registered("SELECT c_custkey::VARCHAR AS value FROM customer")
def s7_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    writers.write_files(_table(spark, sf_dir, "customer").select(F.col("c_custkey").cast("string").alias("value")), path := fresh_path(spark, "text"), "text")
    return readers.read_source(spark, "files", path=path, format="text")


@registered("SELECT c_custkey AS member_id, c_custkey AS member_number FROM customer")
def m4_fallback_mapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Without a mapping table only the key columns are mapped, to themselves."""
    columns = mapping.pairs(mapping.loaded(spark, f"no_such_{fresh_path(spark, 'm').rpartition('-')[2]}", data_col="a", tech_col="b", ongoing_flag="c", origin_flag="d"), "ongoing")
    return mapping.map_columns(_table(spark, sf_dir, "customer").withColumnRenamed("c_custkey", "member_number"), columns)


@registered("SELECT c_custkey AS member_number, CASE WHEN c_custkey = 0 THEN 'FAILED' ELSE 'PASSED' END AS status, CASE WHEN c_custkey = 0 THEN 'Missing required field: member_number' END AS errors FROM customer")
def q6_default_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = quality.annotate(_table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("member_number")))
    return rows.select("member_number", F.col("_dq_status").alias("status"), F.array_join("_dq_errors", ";").alias("errors"))


@registered(f"SELECT c_custkey, status, errors FROM ({_ANNOTATED}) WHERE status = 'PASSED'")
def p5_passed(spark: SparkSession, sf_dir: str) -> DataFrame:
    passed, _ = quality.split(quality.annotate(_incoming(spark, sf_dir), _RULES))
    return passed.select("c_custkey", F.col("_dq_status").alias("status"), F.array_join("_dq_errors", ";").alias("errors"))


@registered("SELECT 'init' AS process, 'run' AS run, 'orders.parquet' AS source, 'table:warehouse.staging.orders' AS target_fqn, true AS timed FROM (SELECT count(*) AS n FROM orders) WHERE n > 0")
def g1_lineage_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = writers.lineage_rows(spark, f"{sf_dir}/orders.parquet", "init", "run", "warehouse.staging.orders")
    return rows.select("process", "run", F.regexp_extract("source_fqn", "orders.parquet", 0).alias("source"), "target_fqn", (F.col("start_time") <= F.col("end_time")).alias("timed")).distinct()
