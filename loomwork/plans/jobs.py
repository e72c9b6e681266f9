"""The composed jobs: plain functions over frames and paths that any scheduler can call."""

from __future__ import annotations

import dataclasses
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from loomwork.functions.scalars import first_truthy
from loomwork.operators import audit, joins, mapping, quality, reports
from loomwork.operators.routing import without_metadata
from loomwork.sources import readers, tables, writers
from loomwork.streaming import streams

Pairs = list[tuple[str, str]]


@dataclasses.dataclass(frozen=True)
class Staged:
    """The outputs of the batch job, before they are written."""

    ongoing: DataFrame
    origin: DataFrame
    audit: DataFrame


def batch_short(source: DataFrame, ongoing: Pairs, origin: Pairs, existing_ongoing: DataFrame, existing_origin: DataFrame, keys: Sequence[str], existing_key: str, newest: Sequence[Column], as_of: Column, rules: Sequence[quality.Rule] = quality.DEFAULT_RULES, by: str = "in_col", passed_only: bool = False) -> Staged:
    """Annotate the day's rows, map them twice with fallback to what is staged, and audit each row. Failed rows are
    staged like others unless ``passed_only``."""
    rows = quality.annotate(source, rules)
    kept = quality.split(rows)[0] if passed_only else rows
    key = first_truthy(kept, keys)
    meta = (as_of.alias("ingested_at"),)
    mapped = [joins.lookup_fallback(kept, old, columns, key, existing_key, newest, by, meta) for columns, old in ((ongoing, existing_ongoing), (origin, existing_origin))]
    return Staged(*mapped, audit.audit_rows(rows, "batch", "short", keys[0], as_of))


def write_staged(staged: Staged, ongoing_path: str, origin_path: str, audit_path: str) -> None:
    """Append the three tables; ``ingested_at`` becomes a real column, other metadata goes."""
    for df, path in ((staged.ongoing, ongoing_path), (staged.origin, origin_path)):
        writers.append(df.withColumn("ingested_at", F.col("_metadata.ingested_at")), path)
    writers.append(staged.audit, audit_path)


def stream_rows(messages: DataFrame, dimension: DataFrame | None, columns: Sequence[str], dimension_key: str, as_of: Column, rules: Sequence[quality.Rule] = (quality.Rule("required", "member_number"),), newest: Sequence[Column] = ()) -> DataFrame:
    """Parsed notifications, enriched if there is a dimension, and annotated. Of a key's dimension rows the first in
    ``newest`` counts; without an order a second row of a key raises."""
    rows = messages
    if dimension is not None:
        rows = joins.enrich(rows, dimension if newest else joins.one_per_key(dimension, dimension_key), "member_number", dimension_key, columns, as_of, newest)
    return quality.annotate(rows, rules)


def stream_sinks(term: str, staging: str, refined: str, columns: mapping.Refreshed | None, as_of: Column, trace: str | None = None, ts: str = "_timestamp") -> dict:
    """The sinks of a term: ``mid`` stages mapped rows and refines raw ones, ``long`` refines only. The mapping is read
    anew as it ages, for each micro-batch has a plan of its own. ``trace`` takes each batch's counts by window of ``ts``
    on the refined branch."""
    refine = lambda batch, _: without_metadata(mapping.stamped(batch, as_of))
    sinks = {refined: refine}
    if trace:
        sinks |= {trace: lambda batch, _: audit.window_trace(batch, ts)}
    if term == "long":
        return sinks
    return {staging: lambda batch, _: without_metadata(mapping.stamped(mapping.map_columns(batch, columns()), as_of)), **sinks}


def stream(messages: DataFrame, dimension: Callable[[], DataFrame] | None, dimension_columns: Sequence[str], dimension_key: str, newest: Sequence[Column], term: str, staging: str, refined: str, trace: str, audited: str, checkpoint: str, columns: mapping.Refreshed | None, as_of: Column, ts: str = "_timestamp") -> StreamingQuery:
    """The stream job on parsed notifications, as one query that reads its source once: each micro-batch is enriched from the
    dimension as ``dimension`` gives it then, annotated, and goes to the term's sinks, the trace and the hourly audit by
    ``ts``, whose closed windows are in ``audited``/closed."""
    prepare = lambda batch: stream_rows(batch, dimension() if dimension else None, dimension_columns, dimension_key, as_of, newest=newest)
    audits = {audited: lambda rows: audit.audit_projection(rows, "member_number", ts)}
    return streams.fan_out(messages, checkpoint, stream_sinks(term, staging, refined, columns, as_of, trace, ts), prepare=prepare, audits=audits)


@dataclasses.dataclass(frozen=True)
class Reconciled:
    personas: DataFrame
    member: DataFrame
    validation: DataFrame


def reconcile(member: DataFrame, personas: DataFrame, mapping_rows: DataFrame, key: str, as_of: Column, root: str, run: str) -> Reconciled:
    """Replace the personas and merge into the member table, both from the same snapshot, and validate. The merge is
    left out if no column is confirmed."""
    triples = joins.mapping_triples(mapping_rows, "reconcile_sts")
    confirmed = joins.mapping_triples(mapping_rows, "reconciled_confirm")
    new_personas = joins.reconcile(member, personas, triples, key, as_of)
    merge = any(flag == "Y" for *_, flag in confirmed)
    new_member = joins.backfill(member, personas, confirmed, key, as_of) if merge else member.withColumn("backfill_timestamp", F.lit(None).cast("timestamp_ntz"))
    new_personas = writers.replaced(new_personas, f"{root}/personas", run)
    new_member = writers.replaced(new_member, f"{root}/member", run)
    summary = reports.mapping_summary(mapping_rows, "reconcile_sts", "reconciled_confirm")
    counts = reports.union_all([reports.validation_row(new_personas, "personas", "reconciled_timestamp"), reports.validation_row(new_member, "member", "backfill_timestamp")])
    return Reconciled(new_personas, new_member, joins.with_summary(counts, summary).withColumn("validation_timestamp", as_of))


class Ledger:
    """The finished steps of one run, each with a small result, below ``root``. A step that is in the ledger isn't done
    again; one that was cut off is."""

    def __init__(self, spark: SparkSession, root: str, run: str):
        self.spark, self.path = spark, f"{root}/ledger/{run}"

    def step(self, name: str, work: Callable[[], object]) -> object:
        now = tables.latest(self.spark, self.path)
        if name not in now.entry:
            now = tables.commit(self.spark, self.path, now, now.entry | {name: work()})
        return now.entry[name]


def reconcile_run(spark: SparkSession, run: str, root: str, mapping_files: str, member_files: str, data_table: str, key: str, as_of: Column, bound: int = 1000) -> Ledger:
    """The whole reconciliation as a run that can be repeated: a second call with the same ``run`` goes on behind the last
    finished step, and after the last changes nothing.

    Mapping and member files are loaded into staging, with lineage of the member's; personas and member are replaced and
    merged from one snapshot, the merge only if a column is confirmed; counts, and the summary of the latest mapping of
    ``data_table``, are added to the log, once a run. Tables below ``root``: ``mapping``, ``member``, ``personas``,
    ``lineage``, ``log``. ``personas`` must have a version."""
    ledger = Ledger(spark, root, run)
    at = lambda name: f"{root}/{name}"
    load = lambda files, name: tables.replace_once(lambda: readers.files(spark, files), at(name), run, spark).number
    source = ledger.step("mapping", lambda: load(mapping_files, "mapping"))
    before = ledger.step("load member", lambda: load(member_files, "member"))
    ledger.step("lineage", lambda: tables.append_once(writers.lineage_rows(spark, member_files, "reconcile", run, "member", end=as_of), at("lineage"), run).number)
    old = ledger.step("snapshot", lambda: tables.latest(spark, at("personas")).number)
    read = lambda name, number: tables.read(spark, at(name), tables.numbered(spark, at(name), number))
    rows = read("mapping", source)
    triples = [joins.mapping_triples(rows, flag, bound) for flag in ("reconcile_sts", "reconciled_confirm")]
    member, personas = read("member", before), read("personas", old)
    made = lambda: joins.reconcile(member, personas, triples[0], key, as_of)
    new = ledger.step("personas", lambda: tables.replace_once(made, at("personas"), run, spark).number)
    confirmed = any(flag == "Y" for *_, flag in triples[1])
    # the load was this run's version of the member table, so the merge has a name of its own
    merge = lambda: tables.replace_once(lambda: joins.backfill(member, personas, triples[1], key, as_of), at("member"), f"{run}-merged", spark).number if confirmed else before
    merged = ledger.step("member", merge)

    def log() -> int:
        newest = rows.agg(F.max("update_dt")).first()[0]
        latest_rows = rows.where((F.col("data_table") == data_table) & F.col("update_dt").eqNullSafe(F.lit(newest)))
        after = read("member", merged)
        if "backfill_timestamp" not in after.columns:
            after = after.withColumn("backfill_timestamp", F.lit(None).cast("timestamp_ntz"))
        counts = reports.union_all([reports.validation_row(read("personas", new), "personas", "reconciled_timestamp"), reports.validation_row(after, "member", "backfill_timestamp")])
        summary = reports.mapping_summary(latest_rows, "reconcile_sts", "reconciled_confirm")
        return tables.append_once(joins.with_summary(counts, summary).withColumn("validation_timestamp", as_of), at("log"), run).number

    ledger.step("log", log)
    return ledger


def hourly_quality(tables: dict[str, tuple[DataFrame, str, str]], as_of: Column, hours: int = 2, least: int = 1000) -> DataFrame:
    """(name: frame, key, time) to one report."""
    return reports.union_all([reports.quality_row(df, name, key, ts, as_of, hours, least) for name, (df, key, ts) in tables.items()]).withColumn("check_timestamp", as_of)


def health(tables: dict[str, tuple[DataFrame, str]], as_of: Column, term: str, environment: str) -> DataFrame:
    """(name: frame, time) to one health log row."""
    rows = [reports.freshness_row(df, name, ts, as_of) for name, (df, ts) in tables.items()]
    return reports.health_row(reports.union_all(rows), as_of, term, environment)
