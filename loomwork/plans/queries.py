"""Registered queries over the driver's tables, each with its DuckDB twin beside it.

``customer`` plays the member table, ``events`` the notifications, ``nation`` a dimension, ``orders`` the log.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loomwork.functions import scalars
from loomwork.operators import audit, joins, mapping, quality, reports, routing
from loomwork.plans import jobs
from loomwork.sources import readers, tables, topics, writers
from loomwork.sources.workspace import fresh_path
from loomwork.streaming import streams

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}

AS_OF = "2024-01-30 12:00:00"


def as_of() -> Column:
    return F.to_timestamp_ntz(F.lit(AS_OF))


def registered(sql: str | None) -> Callable[[Query], Query]:
    def keep(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return keep


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _existing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What was staged before: two customers of three, some without a segment."""
    old = _table(spark, sf_dir, "customer").where("c_custkey % 3 <> 0")
    return old.withColumn("c_mktsegment", F.when(F.col("c_custkey") % 5 != 0, F.concat(F.lit("old "), "c_mktsegment")))


def _incoming(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "customer").withColumn("c_mktsegment", F.when(F.col("c_custkey") % 4 != 0, F.col("c_mktsegment")))


_EXISTING = "SELECT c_custkey, c_name, c_nationkey, c_acctbal, CASE WHEN c_custkey % 5 <> 0 THEN 'old ' || c_mktsegment END AS c_mktsegment FROM customer WHERE c_custkey % 3 <> 0"
_INCOMING = "SELECT c_custkey, c_name, c_nationkey, c_acctbal, CASE WHEN c_custkey % 4 <> 0 THEN c_mktsegment END AS c_mktsegment FROM customer"
# the mapping rows of the tests and queries
_MAPPING = [("segment", "c_mktsegment", "Y", "N", "2024-02-01"), ("c_acctbal", "", "Y", "Y", "2024-02-01"), ("c_nationkey", None, None, None, "2024-02-01"), ("c_mktsegment", "c_mktsegment", "N", "Y", "2024-02-01"), ("old", "x", "Y", "Y", "2024-01-01"), ("undated", "x", "Y", "Y", None)]
_MAPPING_SQL = "(VALUES ('segment','c_mktsegment','Y','N','2024-02-01'),('c_acctbal','','Y','Y','2024-02-01'),('c_nationkey',NULL,NULL,NULL,'2024-02-01'),('c_mktsegment','c_mktsegment','N','Y','2024-02-01'),('old','x','Y','Y','2024-01-01'),('undated','x','Y','Y',NULL)) m(data_schema, tech_schema, reconcile_sts, reconciled_confirm, update_dt)"


def _mapping(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(_MAPPING, "data_schema string, tech_schema string, reconcile_sts string, reconciled_confirm string, update_dt string")


def _derived(spark: SparkSession) -> DataFrame:
    latest = mapping.latest_snapshot(_mapping(spark), "update_dt")
    return mapping.derived(latest, "data_schema", "tech_schema", "reconcile_sts", "reconciled_confirm")


_RULES = (quality.Rule("required", "c_custkey"), quality.Rule("not_null", "c_mktsegment"), quality.Rule("regex", "c_name", "Customer#0*[0-4]"), quality.Rule("range", "c_nationkey", low=2, high=20))
_ERRORS = """list_filter([CASE WHEN c_custkey IS NULL OR c_custkey = 0 THEN 'Missing required field: c_custkey' END,
  CASE WHEN c_mktsegment IS NULL THEN 'Null value in field: c_mktsegment' END,
  CASE WHEN c_name <> '' AND NOT regexp_matches(c_name, '^(?:Customer#0*[0-4])') THEN 'Invalid format in field c_name' END,
  CASE WHEN c_nationkey < 2 THEN 'Value ' || c_nationkey || ' below minimum 2 in field c_nationkey' END,
  CASE WHEN c_nationkey > 20 THEN 'Value ' || c_nationkey || ' above maximum 20 in field c_nationkey' END], lambda x: x IS NOT NULL)"""
_ANNOTATED = f"SELECT *, CASE WHEN len({_ERRORS}) > 0 THEN 'FAILED' ELSE 'PASSED' END AS status, nullif(array_to_string({_ERRORS}, ';'), '') AS errors FROM ({_INCOMING})"


def _annotated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.annotate(_incoming(spark, sf_dir), _RULES)


_LOOKUP = f"SELECT n.c_custkey AS member_id, coalesce(n.c_mktsegment, e.c_mktsegment) AS segment, n.c_acctbal AS balance, NULL::VARCHAR AS absent, e.c_custkey IS NOT NULL AS enriched FROM ({_INCOMING}) n LEFT JOIN ({_EXISTING}) e ON nullif(n.c_custkey, 0) = e.c_custkey"
_PAIRS = [("member_id", "c_custkey"), ("segment", "c_mktsegment"), ("balance", "c_acctbal"), ("absent", "nowhere")]


@registered(_LOOKUP)
def z1_batch_personas(spark: SparkSession, sf_dir: str) -> DataFrame:
    old = _existing(spark, sf_dir)
    staged = jobs.batch_short(_incoming(spark, sf_dir), _PAIRS, _PAIRS[:2], old, old, ["c_custkey"], "c_custkey", [F.col("c_acctbal")], as_of(), _RULES)
    return routing.without_metadata(staged.ongoing.withColumn("enriched", F.col("_metadata.enriched")))


@registered(f"SELECT c_custkey::VARCHAR AS record_id, 'batch' AS pipeline, 'short' AS step, status, TIMESTAMP '{AS_OF}' AS job_time FROM ({_ANNOTATED})")
def z1_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    old = _existing(spark, sf_dir)
    staged = jobs.batch_short(_incoming(spark, sf_dir), _PAIRS, _PAIRS[:2], old, old, ["c_custkey"], "c_custkey", [F.col("c_acctbal")], as_of(), _RULES)
    root = fresh_path(spark, "batch-short")
    jobs.write_staged(staged, f"{root}/ongoing", f"{root}/origin", f"{root}/audit")
    return spark.read.parquet(f"{root}/audit")


@registered(_LOOKUP)
def j1_lookup_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    new = _incoming(spark, sf_dir)
    doubled = _existing(spark, sf_dir).withColumn("at", F.lit(2)).unionByName(_existing(spark, sf_dir).withColumn("c_mktsegment", F.lit("older")).withColumn("at", F.lit(1)))
    out = joins.lookup_fallback(new, doubled, _PAIRS, scalars.first_truthy(new, ["c_custkey"]), "c_custkey", [F.desc("at")])
    return out.select("member_id", "segment", "balance", "absent", F.col("_metadata.enriched").alias("enriched"))


@registered("SELECT c_custkey AS member_id, c_mktsegment AS segment, NULL::VARCHAR AS absent, 'source' AS source_table, '1.0.0' AS pipeline_version FROM customer")
def p1_column_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = mapping.map_columns(_table(spark, sf_dir, "customer"), [("member_id", "c_custkey"), ("segment", "c_mktsegment"), ("absent", "nowhere")], mapping.batch_metadata(as_of(), "source", "target"))
    return out.select("member_id", "segment", "absent", "_metadata.source_table", "_metadata.pipeline_version")


# a mapping of many rows, out of the parts
_PARTS_SQL = "(SELECT 'c' || (p_partkey % 500) AS data_schema, CASE WHEN p_partkey % 4 <> 0 THEN 't' || p_partkey ELSE '' END AS tech_schema, CASE WHEN p_size % 2 = 0 THEN 'Y' ELSE 'N' END AS reconcile_sts, CASE WHEN p_size % 3 = 0 THEN 'Y' END AS reconciled_confirm, CASE p_partkey % 3 WHEN 0 THEN '2024-01-01' WHEN 1 THEN '2024-02-01' END AS update_dt FROM part)"


def _parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    key, size = F.col("p_partkey"), F.col("p_size")
    return _table(spark, sf_dir, "part").select(
        F.concat(F.lit("c"), (key % 500).cast("string")).alias("data_schema"),
        F.when(key % 4 != 0, F.concat(F.lit("t"), key.cast("string"))).otherwise("").alias("tech_schema"),
        F.when(size % 2 == 0, "Y").otherwise("N").alias("reconcile_sts"),
        F.when(size % 3 == 0, "Y").alias("reconciled_confirm"),
        F.when(key % 3 == 0, "2024-01-01").when(key % 3 == 1, "2024-02-01").alias("update_dt"),
    )


_LATEST = f"SELECT * FROM {_PARTS_SQL} WHERE coalesce(update_dt, '1999-12-31') = (SELECT max(coalesce(update_dt, '1999-12-31')) FROM {_PARTS_SQL})"


@registered(_LATEST)
def m1_latest_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mapping.latest_snapshot(_parts(spark, sf_dir), "update_dt")


@registered(
    f"""WITH t AS (SELECT *, coalesce(nullif(tech_schema, ''), data_schema) AS tech FROM ({_LATEST})),
d AS (SELECT data_schema AS out_col, CASE WHEN reconcile_sts = 'Y' THEN tech ELSE data_schema END AS ongoing_in, CASE WHEN reconciled_confirm = 'Y' THEN tech ELSE data_schema END AS origin_in, tech FROM t)
SELECT out_col, ongoing_in, origin_in FROM d QUALIFY row_number() OVER (PARTITION BY out_col ORDER BY tech DESC, ongoing_in DESC, origin_in DESC) = 1
UNION ALL SELECT * FROM (VALUES ('member_id', 'member_number', 'member_number'), ('member_number', 'member_number', 'member_number')) v"""
)
def m2_mapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    latest = mapping.latest_snapshot(_parts(spark, sf_dir), "update_dt")
    return mapping.with_keys(mapping.derived(latest, "data_schema", "tech_schema", "reconcile_sts", "reconciled_confirm"))


@registered("SELECT c_custkey, c_mktsegment AS segment, c_acctbal, c_nationkey, c_mktsegment FROM customer")
def m3_mapped_by_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = mapping.pairs(_derived(spark), "ongoing")
    return mapping.map_columns(_table(spark, sf_dir, "customer"), [("c_custkey", "c_custkey"), *pairs])


@registered(f"SELECT c_custkey, status, errors FROM ({_ANNOTATED})")
def q5_quality_annotate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _annotated(spark, sf_dir).select("c_custkey", F.col("_dq_status").alias("status"), F.array_join("_dq_errors", ";").alias("errors"))


@registered(f"SELECT c_custkey, status FROM ({_ANNOTATED}) WHERE status = 'FAILED'")
def p5_quality_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    passed, failed = quality.split(_annotated(spark, sf_dir))
    path = fresh_path(spark, "rejects")
    writers.write_rejects(failed.select("c_custkey", F.col("_dq_status").alias("status")), path)
    return spark.read.parquet(path)


@registered("SELECT 'rich' AS branch, count(*) AS n FROM customer WHERE c_acctbal > 5000 UNION ALL SELECT 'asia', count(*) FROM customer WHERE c_nationkey < 15 UNION ALL SELECT 'rest', count(*) FROM customer")
def p6_branches(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = routing.branches(_table(spark, sf_dir, "customer"), {"rich": "c_acctbal > 5000", "asia": "c_nationkey < 15", "rest": None})
    return reports.union_all([df.agg(F.count("*").alias("n")).select(F.lit(name).alias("branch"), "n") for name, df in found.items()])


@registered("SELECT event_id, CASE WHEN event_type = 'error' THEN 'bad event' END AS error, CASE WHEN event_type = 'error' THEN 'bad event' WHEN event_type = 'view' THEN '' END AS kept FROM events")
def p7_error_route(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "events").withColumn("_error", F.when(F.col("event_type") == "error", "bad event").when(F.col("event_type") == "view", ""))
    good, errors = routing.error_routes(rows, as_of())
    return reports.union_all([errors.select("record.event_id", "error", F.col("record._error").alias("kept")), good.select("event_id", F.lit(None).cast("string").alias("error"), F.col("_error").alias("kept"))])


@registered(f"SELECT TIMESTAMP '{AS_OF}' AS job_time, 'p' AS pipeline, 's' AS step, c_custkey::VARCHAR AS record_id, 'PROCESSED' AS status FROM customer")
def p8_audit_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.audit_rows(_table(spark, sf_dir, "customer"), "p", "s", "c_custkey", as_of())


@registered("SELECT user_id AS member_number, ts AS timestamp, 'UNKNOWN' AS _dq_status FROM events")
def p9_audit_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.audit_projection(_table(spark, sf_dir, "events"), "user_id", "ts")


@registered(f"SELECT user_id AS member, event_type AS kind, ts AS stream_timestamp, 'stg' AS target_table, TIMESTAMP '{AS_OF}' AS ingested_at FROM events")
def p2_stream_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "events").withColumnRenamed("ts", "_timestamp")
    out = mapping.map_columns(rows, [("member", "user_id"), ("kind", "event_type")], mapping.stream_metadata(rows, as_of(), "stg"))
    return mapping.stamped(out, as_of()).select("member", "kind", "_metadata.stream_timestamp", "_metadata.target_table", "ingested_at")


@registered(f"SELECT * FROM events WHERE ts::DATE = DATE '2024-01-30' AND ts >= TIMESTAMP '{AS_OF}' - INTERVAL 3 HOUR")
def p12_recency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "events").where(scalars.recent(F.col("ts"), as_of(), 3))


@registered(f"SELECT * FROM {_PARTS_SQL} WHERE reconcile_sts = 'Y' AND update_dt = (SELECT max(update_dt) FROM {_PARTS_SQL} WHERE reconcile_sts = 'Y')")
def p13_latest_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mapping.latest_snapshot(_parts(spark, sf_dir), "update_dt", F.col("reconcile_sts") == "Y")


@registered("SELECT c_custkey, c_acctbal * 2 AS doubled FROM customer WHERE c_acctbal > 0")
def x2_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    steps = [lambda d: d.where("c_acctbal > 0"), (lambda d: d.limit(0), False), lambda d: d.select("c_custkey", (F.col("c_acctbal") * 2).alias("doubled"))]
    return routing.chained(_table(spark, sf_dir, "customer"), steps)


@registered("SELECT c_custkey, c_name, c_nationkey, 2 AS copies FROM customer")
def s_formats(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey")
    read = []
    for form in ("parquet", "json"):
        writers.write_files(rows, path := fresh_path(spark, form), form)
        read.append(readers.read_source(spark, "files", path=path, format=form, schema="c_custkey long, c_name string, c_nationkey int"))
    return reports.union_all(read).groupBy("c_custkey", "c_name", "c_nationkey").agg(F.count("*").cast("int").alias("copies"))


@registered("SELECT c_custkey, c_name FROM customer ORDER BY c_acctbal DESC, c_custkey LIMIT 100")
def s12_bounded_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = readers.bounded(_table(spark, sf_dir, "customer"), ["c_custkey", "c_name", "c_acctbal"], 100, F.desc("c_acctbal"), F.asc("c_custkey"))
    return rows.drop("c_acctbal")


@registered("SELECT n.* FROM nation n WHERE n_nationkey IN (SELECT c_nationkey FROM customer WHERE c_acctbal > 9900)")
def s10_keyed_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = _table(spark, sf_dir, "customer").where("c_acctbal > 9900").select(F.col("c_nationkey").alias("n_nationkey"))
    return readers.keyed_dimension(_table(spark, sf_dir, "nation"), ["n_name", "n_regionkey"], keys, "n_nationkey")


@registered("SELECT * FROM customer")
def s11_bulk_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    return writers.bulk_load(spark, f"{sf_dir}/customer.parquet", fresh_path(spark, "staging"), lineage=fresh_path(spark, "lineage"))


@registered(None)
def g1_lineage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return writers.lineage_rows(spark, f"{sf_dir}/orders.parquet", "init", "run", "warehouse.staging.orders")


@registered("SELECT c_custkey, c_name, 2 AS n FROM customer")
def k1_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, path = _table(spark, sf_dir, "customer").select("c_custkey", "c_name", F.lit(1).alias("_hidden")), fresh_path(spark, "appended")
    for _ in range(2):
        writers.append(rows, path)
    return spark.read.parquet(path).groupBy("c_custkey", "c_name").agg(F.count("*").cast("int").alias("n"))


@registered("SELECT c_custkey FROM customer WHERE c_custkey % 2 = 1")
def k2_dispositions(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, path = _table(spark, sf_dir, "customer").select("c_custkey"), fresh_path(spark, "written")
    writers.write_table(rows.limit(0), path, "empty")
    writers.write_table(rows, path, "empty")
    writers.write_table(rows.where("c_custkey % 2 = 1"), path, "truncate")
    return spark.read.parquet(path)


@registered("SELECT c_custkey, c_name FROM customer")
def k6_publish(spark: SparkSession, sf_dir: str) -> DataFrame:
    writers.publish(_table(spark, sf_dir, "customer").select("c_custkey", "c_name"), path := fresh_path(spark, "topic"))
    return spark.read.text(path).select(scalars.parsed_json(F.col("value"), "c_custkey long, c_name string").alias("m")).select("m.*")


@registered("SELECT c_custkey, CASE WHEN c_custkey % 7 = 0 THEN 'changed' ELSE c_name END AS c_name FROM customer UNION ALL SELECT -c_custkey - 1, 'added' FROM customer WHERE c_custkey % 7 = 0")
def k7_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    old = _table(spark, sf_dir, "customer").select("c_custkey", "c_name", F.lit(1).alias("at"))
    some = old.where("c_custkey % 7 = 0").withColumn("at", F.lit(2))
    new = some.withColumn("c_name", F.lit("changed")).unionByName(some.withColumn("c_name", F.lit("added")).withColumn("c_custkey", -F.col("c_custkey") - 1))
    root = fresh_path(spark, "dimension")
    first = writers.replaced(old, root, "1")
    return writers.replaced(joins.upserted(first, new, "c_custkey", F.desc("at")), root, "2").drop("at")


_TRIPLES = [("c_mktsegment", "segment", "Y"), ("c_acctbal", "c_acctbal", "N"), ("c_custkey", "c_custkey", "Y")]
_PERSONAS = "SELECT c_custkey, CASE WHEN c_custkey % 5 <> 0 THEN 'p ' || c_mktsegment END AS segment, CASE WHEN c_custkey % 2 = 0 THEN c_nationkey + 100 END AS c_nationkey FROM customer WHERE c_custkey % 3 <> 0"


def _personas(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("c_custkey")
    return _table(spark, sf_dir, "customer").where(key % 3 != 0).select("c_custkey", F.when(key % 5 != 0, F.concat(F.lit("p "), "c_mktsegment")).alias("segment"), F.when(key % 2 == 0, F.col("c_nationkey") + 100).alias("c_nationkey"))


_RECONCILED = f"SELECT o.c_custkey, coalesce(n.segment, o.c_mktsegment) AS segment, o.c_acctbal, TIMESTAMP '{AS_OF}' AS reconciled_timestamp, '20240130' AS reconciliation_batch FROM customer o LEFT JOIN ({_PERSONAS}) n ON o.c_custkey = n.c_custkey"
_BACKFILLED = f"SELECT o.c_custkey, o.c_name, coalesce(n.c_nationkey, o.c_nationkey) AS c_nationkey, o.c_acctbal, coalesce(n.segment, o.c_mktsegment) AS c_mktsegment, CASE WHEN n.c_custkey IS NOT NULL THEN TIMESTAMP '{AS_OF}' END AS backfill_timestamp FROM customer o LEFT JOIN ({_PERSONAS}) n ON o.c_custkey = n.c_custkey"


@registered(_RECONCILED)
def j3_reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return joins.reconcile(_table(spark, sf_dir, "customer"), _personas(spark, sf_dir), _TRIPLES, "c_custkey", as_of())


def _backfilled(spark: SparkSession, sf_dir: str) -> DataFrame:
    member = _table(spark, sf_dir, "customer").withColumn("backfill_timestamp", F.lit(None).cast("timestamp_ntz"))
    return joins.backfill(member, _personas(spark, sf_dir), [("c_mktsegment", "segment", "Y"), ("c_nationkey", "", "Y"), ("c_acctbal", "", "N")], "c_custkey", as_of())


@registered(_BACKFILLED)
def j4_backfill(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _backfilled(spark, sf_dir)


@registered(_BACKFILLED)
def k9_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return writers.replaced(_backfilled(spark, sf_dir), fresh_path(spark, "member"), "1")


_ENRICHED = "SELECT e.event_id, e.user_id, coalesce(c.c_mktsegment, e.event_type) AS event_type, c.c_name FROM (SELECT event_id, nullif(user_id, 0) AS k, user_id, event_type FROM events) e LEFT JOIN (SELECT c_custkey, c_name, CASE WHEN c_custkey % 2 = 0 THEN c_mktsegment END AS c_mktsegment FROM customer) c ON e.k = c.c_custkey"


@registered(_ENRICHED)
def j2_enrich(spark: SparkSession, sf_dir: str) -> DataFrame:
    dim = _table(spark, sf_dir, "customer").select("c_custkey", "c_name", F.when(F.col("c_custkey") % 2 == 0, F.col("c_mktsegment")).alias("event_type"))
    out = joins.enrich(_table(spark, sf_dir, "events").select("event_id", "user_id", "event_type"), dim, "user_id", "c_custkey", ["event_type", "c_name"], as_of())
    return routing.without_metadata(out)


@registered("SELECT c_custkey, n_name, n_regionkey FROM customer JOIN nation ON c_nationkey = n_nationkey")
def p11_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    family = _table(spark, sf_dir, "nation").select("n_nationkey", F.struct("n_name", "n_regionkey").alias("cf"))
    rows = _table(spark, sf_dir, "customer").withColumn("n_name", F.lit("own")).join(family, F.col("c_nationkey") == F.col("n_nationkey"))
    return joins.flattened(rows.select("c_custkey", "n_name", "cf"), "cf")


@registered("SELECT * FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_totalprice > 150000)")
def j7_key_restrict(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = _table(spark, sf_dir, "orders").where("o_totalprice > 150000").select(F.col("o_custkey").alias("c_custkey"))
    return joins.restricted(_table(spark, sf_dir, "customer"), keys, "c_custkey")


@registered(
    "SELECT c_custkey, CASE WHEN c_custkey % 10 = 1 THEN 'removed' WHEN c_custkey % 10 = 2 THEN 'added' WHEN c_custkey % 10 = 3 THEN 'changed' ELSE 'same' END AS change FROM customer"
)
def j8_row_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment")
    after = rows.where("c_custkey % 10 <> 1").withColumn("c_name", F.when(F.col("c_custkey") % 10 != 3, F.col("c_name")))
    return joins.row_diff(rows.where("c_custkey % 10 <> 2"), after, "c_custkey", ["c_mktsegment", "c_name"])


@registered("SELECT c_custkey, sha256(coalesce(c_custkey::VARCHAR, 'None') || '|' || coalesce(c_mktsegment, 'None') || '|' || '|') AS record_hash FROM (" + _INCOMING + ")")
def c12_record_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _incoming(spark, sf_dir)
    return rows.select("c_custkey", scalars.record_hash(rows, ["c_mktsegment", "zzz_absent", "c_custkey"]).alias("record_hash"))


@registered(
    f"""SELECT o_orderkey, o_orderdate::DATE AS day, strftime(o_orderdate, '%Y%m%d') AS label,
 date_diff('minute', o_orderdate + to_seconds(o_orderkey % 97), TIMESTAMP '{AS_OF}')::BIGINT AS minutes,
 coalesce(nullif(CASE WHEN o_orderkey % 2 = 0 THEN '' ELSE o_orderpriority END, ''), 'none') AS priority,
 CASE WHEN o_orderkey % 3 = 0 THEN 's3:b.p/' || o_orderkey WHEN o_orderkey % 3 = 1 THEN 's3:b' || o_orderkey ELSE 's3:/x' END AS fqn,
 o_orderkey::VARCHAR AS last, CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS done FROM orders"""
)
def c_scalars(spark: SparkSession, sf_dir: str) -> DataFrame:
    o, key = _table(spark, sf_dir, "orders"), F.col("o_orderkey")
    text = key.cast("string")
    uri = F.when(key % 3 == 0, F.concat(F.lit("s3://b/p/"), text)).when(key % 3 == 1, F.concat(F.lit("s3://b"), text)).otherwise("/x")
    placed = F.timestamp_add("SECOND", (key % 97).cast("int"), F.col("o_orderdate"))
    return o.select(
        "o_orderkey",
        F.to_date("o_orderdate").alias("day"),
        scalars.batch_label(F.col("o_orderdate")).alias("label"),
        scalars.minutes_between(as_of(), placed).alias("minutes"),
        scalars.text_or(F.when(key % 2 == 0, "").otherwise(F.col("o_orderpriority")), F.lit("none")).alias("priority"),
        scalars.object_name(uri).alias("fqn"),
        scalars.last_segment(F.concat(F.lit("a/b/"), text)).alias("last"),
        F.when(F.col("o_orderstatus") == "F", 1).otherwise(0).alias("done"),
    )


_AUDIT = "SELECT time_bucket(INTERVAL 1 HOUR, ts) AS window_start, time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR AS window_end, count(*) AS records_processed, count(DISTINCT user_id) + max((user_id IS NULL)::INT) AS unique_count, count(*) FILTER (event_type = 'error') AS error_count, (count(*) - count(*) FILTER (event_type = 'error')) / count(*)::DOUBLE AS success_rate, min(ts) AS first_seen, max(ts) AS last_seen, (epoch(date_trunc('second', max(ts))) - epoch(date_trunc('second', min(ts))))::BIGINT AS duration_seconds FROM events GROUP BY 1, 2"


def _audited(events: DataFrame) -> DataFrame:
    return events.select(F.col("user_id").alias("member_number"), F.col("ts").alias("timestamp"), F.when(F.col("event_type") == "error", "FAILED").otherwise("PASSED").alias("_dq_status"))


@registered(_AUDIT)
def a1_windowed_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.windowed_audit(_audited(_table(spark, sf_dir, "events")))


@registered("SELECT time_bucket(INTERVAL 1 HOUR, ts) AS window_start, time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR AS window_end, count(*) AS record_count, min(ts) AS first_seen, max(ts) AS last_seen FROM events GROUP BY 1, 2")
def a9_window_trace(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.window_trace(_table(spark, sf_dir, "events"), "ts")


_RECENT = f"ts::DATE = DATE '2024-01-30' AND ts >= TIMESTAMP '{AS_OF}' - INTERVAL 6 HOUR"
_QUALITY = f"SELECT 'all' AS table_name, count(*) AS record_count, count(DISTINCT user_id) AS unique_members, max(ts) AS last_ingested, CASE WHEN count(*) < 100 THEN 'WARNING: Low record count' ELSE 'OK' END AS status, TIMESTAMP '{AS_OF}' AS check_timestamp FROM events WHERE {_RECENT} UNION ALL SELECT 'errors', count(*), count(DISTINCT user_id), max(ts), CASE WHEN count(*) < 100 THEN 'WARNING: Low record count' ELSE 'OK' END, TIMESTAMP '{AS_OF}' FROM events WHERE {_RECENT} AND event_type = 'error'"


@registered(_QUALITY)
def z6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _table(spark, sf_dir, "events")
    return jobs.hourly_quality({"all": (events, "user_id", "ts"), "errors": (events.where("event_type = 'error'"), "user_id", "ts")}, as_of(), 6, 100)


@registered(_QUALITY.replace(f", TIMESTAMP '{AS_OF}' AS check_timestamp", "").replace(f", TIMESTAMP '{AS_OF}' FROM", " FROM"))
def a2_quality_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _table(spark, sf_dir, "events")
    return reports.union_all([reports.quality_row(df, n, "user_id", "ts", as_of(), 6, 100) for n, df in (("all", events), ("errors", events.where("event_type = 'error'")))])



@registered(
    f"""WITH t AS (SELECT 'before' AS table_name, max(ts) AS last_ingested FROM events WHERE ts::DATE = DATE '2024-01-30' AND ts < TIMESTAMP '2024-01-30 09:00:00'
 UNION ALL SELECT 'none', max(ts) FROM events WHERE ts::DATE = DATE '2024-01-30' AND event_type = 'no such'),
 m AS (SELECT *, date_diff('minute', last_ingested, TIMESTAMP '{AS_OF}')::BIGINT AS minutes_since_update FROM t)
 SELECT *, CASE WHEN minutes_since_update > 120 THEN 'ALERT: Data stale' WHEN minutes_since_update > 60 THEN 'WARNING: Check pipeline' ELSE 'OK' END AS health_status FROM m"""
)
def a3_freshness(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _table(spark, sf_dir, "events")
    frames = {"before": events.where("ts < timestamp_ntz'2024-01-30 09:00:00'"), "none": events.where("event_type = 'no such'")}
    return reports.union_all([reports.freshness_row(df, name, "ts", as_of()) for name, df in frames.items()])


@registered(
    f"""WITH t AS (SELECT 'early' AS table_name, max(ts) AS last FROM events WHERE ts::DATE = DATE '2024-01-30' AND ts < TIMESTAMP '2024-01-30 09:00:00'
 UNION ALL SELECT 'events', max(ts) FROM events WHERE ts::DATE = DATE '2024-01-30'),
 m AS (SELECT *, date_diff('minute', last, TIMESTAMP '{AS_OF}')::BIGINT AS n FROM t),
 s AS (SELECT *, CASE WHEN n > 120 THEN 'ALERT: Data stale' WHEN n > 60 THEN 'WARNING: Check pipeline' ELSE 'OK' END AS label FROM m)
 SELECT TIMESTAMP '{AS_OF}' AS check_timestamp, 'stale' AS term_type, 'test' AS environment,
 '[' || string_agg('{{"table_name":"' || table_name || '",' || coalesce('"minutes_since_update":' || n || ',', '') || '"health_status":"' || label || '"}}', ',' ORDER BY table_name) || ']' AS health_metrics,
 CASE WHEN bool_or(label LIKE 'ALERT%') THEN 'CRITICAL' WHEN bool_or(label LIKE 'WARNING%') THEN 'WARNING' ELSE 'HEALTHY' END AS overall_status FROM s"""
)
def z7_health(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _table(spark, sf_dir, "events")
    row = jobs.health({"events": (events, "ts"), "early": (events.where("ts < timestamp_ntz'2024-01-30 09:00:00'"), "ts")}, as_of(), "stale", "test")
    writers.append(row, path := fresh_path(spark, "health-log"))
    return spark.read.parquet(path)


_SUMMARY = f"SELECT count(*) AS total_columns, count(*) FILTER (reconcile_sts = 'Y') AS reconciling, count(*) FILTER (reconciled_confirm = 'Y') AS confirmed FROM {_MAPPING_SQL}"


@registered(f"SELECT table_name, record_count, last_reconciled, total_columns, reconciling, confirmed FROM (SELECT 'customer' AS table_name, (SELECT count(*) FROM orders) AS record_count, (SELECT max(o_orderdate) FROM orders) AS last_reconciled), ({_SUMMARY})")
def a5_validation(spark: SparkSession, sf_dir: str) -> DataFrame:
    row = reports.validation_row(_table(spark, sf_dir, "orders"), "customer", "o_orderdate")
    return joins.with_summary(row, reports.mapping_summary(_mapping(spark), "reconcile_sts", "reconciled_confirm"))


@registered("SELECT 'events' AS table_name, count(*) AS record_count, max(ts) AS last_ingested FROM events WHERE ts::DATE = DATE '2024-01-30'")
def a11_daily_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.daily_row(_table(spark, sf_dir, "events"), "events", "ts", F.to_date(as_of()))


@registered(f"SELECT count(*) AS records_processed, sum(len({_ERRORS}))::BIGINT AS dq_errors, count(*) FILTER (len({_ERRORS}) = 0) AS dq_passed, count(*) FILTER (c_mktsegment IS NULL) AS null_values FROM ({_INCOMING})")
def a7_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.counters(_annotated(spark, sf_dir), ["c_mktsegment"])


@registered(
    """WITH s AS (SELECT 'm' || (user_id % 4) AS name, CASE user_id % 4 WHEN 0 THEN 'counter' WHEN 1 THEN 'gauge' WHEN 2 THEN 'histogram' ELSE 'timer' END AS kind, (event_id % 101)::DOUBLE AS value, event_id AS seq FROM events)
SELECT name, kind, CASE kind WHEN 'counter' THEN sum(value) WHEN 'gauge' THEN arg_max(value, seq) END AS value,
 CASE WHEN kind = 'histogram' THEN count(*) END AS sample_count, CASE WHEN kind = 'histogram' THEN sum(value) END AS sample_sum, CASE WHEN kind = 'histogram' THEN avg(value) END AS sample_avg,
 CASE WHEN kind = 'histogram' THEN min(value) END AS sample_min, CASE WHEN kind = 'histogram' THEN max(value) END AS sample_max FROM s WHERE kind <> 'timer' GROUP BY name, kind"""
)
def a8_metric_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    four = F.col("user_id") % 4
    kind = F.when(four == 0, "counter").when(four == 1, "gauge").when(four == 2, "histogram").otherwise("timer")
    return audit.metric_rollup(_table(spark, sf_dir, "events").select(F.concat(F.lit("m"), four.cast("string")).alias("name"), kind.alias("kind"), (F.col("event_id") % 101).cast("double").alias("value"), F.col("event_id").alias("seq")))


@registered("SELECT event_id, error_count FROM (SELECT event_id FROM events WHERE event_type = 'error' ORDER BY ts, event_id LIMIT 10), (SELECT count(*) AS error_count FROM events WHERE event_type = 'error')")
def a12_error_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    errors = _table(spark, sf_dir, "events").where("event_type = 'error'")
    return audit.error_digest(errors.select("event_id", "ts"), [F.asc("ts"), F.asc("event_id")]).drop("ts")


@registered("SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderdate::DATE = (SELECT max(o_orderdate::DATE) FROM orders) ORDER BY o_orderdate DESC, o_orderkey LIMIT 10")
def l1_latest_n(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    day = orders.agg(F.max(F.to_date("o_orderdate"))).first()[0]
    return audit.latest_rows(orders, "o_orderdate", F.lit(day), F.asc("o_orderkey"))


_PAYLOAD = "CASE event_id % 4 WHEN 0 THEN '{\"member_number\": \"' || user_id || '\"}' WHEN 1 THEN '{\"profileId\": \"' || user_id || '\", \"type\": \"insert\"}' WHEN 2 THEN '{\"member_number\": \"\", \"member_id\": \"m' || user_id || '\"}' ELSE '{bad' END"


def _messages(events: DataFrame) -> DataFrame:
    return events.select("event_id", "ts", F.expr(_PAYLOAD).alias("value"))


@registered("SELECT event_id, CASE event_id % 4 WHEN 2 THEN 'm' || user_id ELSE user_id::VARCHAR END AS member_number, CASE event_id % 4 WHEN 1 THEN 'insert' ELSE 'update' END AS kind FROM events WHERE event_id % 4 <> 3 AND (event_id % 4 = 2 OR user_id <> 0)")
def w1_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = streams.notifications(_messages(_table(spark, sf_dir, "events")), "value", as_of())
    return rows.select("event_id", "member_number", F.col("_notification_type").alias("kind"))


def _stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = _table(spark, sf_dir, "events").schema
    return readers.messages(spark, topic=sf_dir, schema=schema, glob="events.parquet", format="parquet").withColumn("ts", F.col("ts").cast("timestamp"))


def _ran(query) -> None:
    query.awaitTermination()


@registered(f"SELECT * FROM ({_AUDIT}) WHERE window_end <= (SELECT max(ts) FROM events)")
def w3_stream_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    out, at = fresh_path(spark, "windows"), fresh_path(spark, "checkpoint")
    _ran(streams.to_files(streams.stream_audit(_audited(_stream(spark, sf_dir))), out, at))
    rows = spark.read.parquet(out)
    return rows.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("window_start", "window_end", "first_seen", "last_seen")})


@registered("SELECT time_bucket(INTERVAL 1 HOUR, ts) AS window_start, count(*) AS record_count FROM events GROUP BY 1")
def w5_panes(spark: SparkSession, sf_dir: str) -> DataFrame:
    out, at = fresh_path(spark, "panes"), fresh_path(spark, "checkpoint")
    _ran(streams.fan_out(_audited(_stream(spark, sf_dir)), at, {out: lambda batch, i: streams.panes(batch, i).withColumnRenamed("batch_id", "batch")}))
    return spark.read.parquet(out).groupBy(F.col("window_start").cast("timestamp_ntz").alias("window_start")).agg(F.sum("record_count").alias("record_count"))


@registered("SELECT event_id, ts FROM events")
def s9_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    stream = _stream(spark, sf_dir).select("event_id", "ts", F.explode(F.array(F.lit(1), F.lit(2))).alias("delivery"))
    out, at = fresh_path(spark, "once"), fresh_path(spark, "checkpoint")
    _ran(streams.to_files(readers.deduplicated(stream, "event_id", "ts").select("event_id", "ts"), out, at))
    return spark.read.parquet(out).withColumn("ts", F.col("ts").cast("timestamp_ntz"))


def _streamed(spark: SparkSession, sf_dir: str, term: str) -> tuple[str, str, str, str]:
    """The paths of the staging, refined, trace and audit tables that the stream job fills."""
    root = fresh_path(spark, "dimension")
    tables.replace(_table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal"), root, "first")
    parsed = streams.notifications(_messages(_stream(spark, sf_dir)), "value", F.current_timestamp())
    paths = tuple(fresh_path(spark, name) for name in ("staging", "refined", "trace", "audit"))
    pairs = mapping.Refreshed(lambda: [("member", "member_number"), ("name", "c_name"), ("event", "event_id")])
    _ran(jobs.stream(parsed, lambda: tables.read(spark, root), ["c_name"], "c_custkey", [F.desc("c_acctbal")], term, *paths, fresh_path(spark, "checkpoint"), pairs, as_of(), "ts"))
    return *paths[:3], f"{paths[3]}/closed"


_STREAMED = "SELECT event_id, member_number, c_name FROM (SELECT event_id, CASE event_id % 4 WHEN 2 THEN 'm' || user_id ELSE user_id::VARCHAR END AS member_number FROM events WHERE event_id % 4 <> 3 AND (event_id % 4 = 2 OR user_id <> 0)) LEFT JOIN customer ON member_number = c_custkey::VARCHAR"


@registered(f"SELECT member_number AS member, c_name AS name, event_id AS event, TIMESTAMP '{AS_OF}' AS ingested_at FROM ({_STREAMED})")
def z2_stream_mid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(_streamed(spark, sf_dir, "mid")[0]).select("member", "name", "event", "ingested_at")


@registered(_STREAMED)
def z3_stream_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(_streamed(spark, sf_dir, "long")[1]).select("event_id", "member_number", "c_name")


@registered("SELECT CASE WHEN event_id % 2 = 0 THEN user_id ELSE event_id END AS member FROM events")
def m5_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two micro-batches of the events under a mapping that changes between them."""
    clock = iter((0.0, 700.0))
    versions = iter(([("member", "user_id")], [("member", "event_id")]))
    columns = mapping.Refreshed(lambda: next(versions), 600, lambda: next(clock))
    events = _table(spark, sf_dir, "events")
    return reports.union_all([mapping.map_columns(half, columns()) for half in (events.where("event_id % 2 = 0"), events.where("event_id % 2 = 1"))])


@registered("SELECT event_id, 'day' AS way FROM events WHERE CAST(ts AS DATE) = DATE '2024-01-30' UNION ALL SELECT event_id, 'condition' FROM events WHERE value > 50")
def s3_partition_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of one day, and those under a condition, of a table that is partitioned by its day."""
    path = fresh_path(spark, "by-day")
    _table(spark, sf_dir, "events").withColumn("day", F.to_date("ts")).write.partitionBy("day").parquet(path)
    rows = readers.files(spark, path)
    day, some = readers.partition_scan(rows, date_col="day", as_of=as_of()), readers.partition_scan(rows, "value > 50")
    return reports.union_all([day.select("event_id", F.lit("day").alias("way")), some.select("event_id", F.lit("condition").alias("way"))])


@registered(
    f"""WITH m AS ({_SUMMARY}) SELECT table_name, record_count, last_reconciled, total_columns, reconciling, confirmed, TIMESTAMP '{AS_OF}' AS validation_timestamp FROM (
 SELECT 'personas' AS table_name, count(*) AS record_count, max(reconciled_timestamp) AS last_reconciled FROM ({_RECONCILED})
 UNION ALL SELECT 'member', count(*), max(backfill_timestamp) FROM ({_BACKFILLED})), m"""
)
def z4_reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    member = _table(spark, sf_dir, "customer").withColumn("backfill_timestamp", F.lit(None).cast("timestamp_ntz"))
    done = jobs.reconcile(member, _personas(spark, sf_dir).withColumnRenamed("segment", "c_mktsegment"), _mapping(spark), "c_custkey", as_of(), fresh_path(spark, "reconcile"), "20240130")
    return done.validation
