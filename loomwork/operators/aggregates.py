"""Aggregates of one's own: create, add, merge and extract, as Spark's built-in ones work.

Each task adds its rows to one state a key, in Arrow batches, and only states are dealt out; they are merged by key in two
steps, so a key that every task has, a busy window, meets as a few states and not as rows. A task that has more keys than
``KEYS`` hands over its states and starts anew, so its memory is bounded by these.

A null in a key is a key of its own. Without rows there is no row. States must be picklable.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator, Sequence
from typing import Any, Protocol

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Keys whose states a task holds, and parts that a key's states are merged in first.
KEYS = 10_000
PARTS = 16


class Aggregate(Protocol):
    def create(self) -> Any: ...

    def add(self, state: Any, rows: pa.Table) -> Any:
        """The state after some rows of one key."""

    def merge(self, state: Any, other: Any) -> Any: ...

    def extract(self, state: Any) -> dict[str, Any]:
        """The result's columns."""


def _keyed(table: pa.Table, keys: Sequence[str]) -> Iterator[tuple[tuple, pa.Table]]:
    """The rows of each key of a batch."""
    numbered = table.append_column("_at", pa.array(np.arange(table.num_rows)))
    for row in numbered.group_by(list(keys)).aggregate([("_at", "list")]).to_pylist():
        yield tuple(row[k] for k in keys), table.take(pa.array(row["_at_list"]))


def _kinds(df: DataFrame, keys: Sequence[str]) -> str:
    return ", ".join(f"`{k}` {df.schema[k].dataType.simpleString()}" for k in keys)


def partial_states(df: DataFrame, keys: Sequence[str], inputs: Sequence[str], aggregate: Aggregate) -> DataFrame:
    """(keys, _state): what each task has of each key, one row unless its states had to go on the way."""

    def states(held: dict[tuple, Any], types: Sequence[pa.DataType]) -> pa.RecordBatch:
        columns = [pa.array([k[i] for k in held], t) for i, t in enumerate(types)]
        return pa.RecordBatch.from_arrays([*columns, pa.array([pickle.dumps(s) for s in held.values()], pa.binary())], [*keys, "_state"])

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, Any] = {}
        types: list[pa.DataType] = []
        for batch in batches:
            types = [batch.schema.field(k).type for k in keys]
            for key, rows in _keyed(pa.Table.from_batches([batch]), keys):
                held[key] = aggregate.add(held[key] if key in held else aggregate.create(), rows)
            if len(held) > KEYS:
                yield states(held, types)
                held = {}
        if held:
            yield states(held, types)

    return df.select(*keys, *[c for c in inputs if c not in keys]).mapInArrow(partial, f"{_kinds(df, keys)}, _state binary")


def user_aggregate(df: DataFrame, keys: Sequence[str], inputs: Sequence[str], aggregate: Aggregate, schema: str) -> DataFrame:
    """A row for each key of ``df``: the keys, and what ``aggregate`` extracts of ``inputs``, as ``schema`` names it."""

    def merged(table: pa.Table) -> Any:
        state = aggregate.create()
        for blob in table["_state"]:
            state = aggregate.merge(state, pickle.loads(blob.as_py()))  # noqa: S301  of this job's own tasks
        return state

    def some(table: pa.Table) -> pa.Table:
        return table.select(keys).slice(0, 1).append_column("_state", pa.array([pickle.dumps(merged(table))], pa.binary()))

    def last(table: pa.Table) -> pa.Table:
        out = table.select(keys).slice(0, 1)
        for name, value in aggregate.extract(merged(table)).items():
            out = out.append_column(name, pa.array([value]))
        return out

    each, kinds = partial_states(df, keys, inputs, aggregate), _kinds(df, keys)
    dealt = each.withColumn("_part", F.pmod(F.xxhash64("_state"), F.lit(PARTS))).groupBy(*keys, "_part").applyInArrow(some, f"{kinds}, _state binary")
    return dealt.groupBy(*keys).applyInArrow(last, f"{kinds}, {schema}")


class WindowAudit:
    """The windowed audit of (member_number, timestamp, _dq_status) as such an aggregate. Its state holds the window's
    ids, which ``audit.windowed_audit`` leaves to Spark."""

    SCHEMA = "records_processed long, unique_count long, error_count long, success_rate double, first_seen timestamp_ntz, last_seen timestamp_ntz, duration_seconds long"

    def create(self) -> tuple:
        return 0, 0, frozenset(), None, None

    def add(self, state: tuple, rows: pa.Table) -> tuple:
        times = [t for t in rows["timestamp"].to_pylist() if t is not None]
        failed = rows["_dq_status"].to_pylist().count("FAILED")
        return self.merge(state, (rows.num_rows, failed, frozenset(rows["member_number"].to_pylist()), min(times, default=None), max(times, default=None)))

    def merge(self, state: tuple, other: tuple) -> tuple:
        n, failed, ids, first, last = (*zip(state, other, strict=True),)
        return sum(n), sum(failed), ids[0] | ids[1], min((t for t in first if t is not None), default=None), max((t for t in last if t is not None), default=None)

    def extract(self, state: tuple) -> dict[str, Any]:
        n, failed, ids, first, last = state
        seconds = int(last.replace(microsecond=0).timestamp() - first.replace(microsecond=0).timestamp()) if first is not None else None
        return {"records_processed": n, "unique_count": len(ids), "error_count": failed, "success_rate": (n - failed) / max(n, 1), "first_seen": first, "last_seen": last, "duration_seconds": seconds}
