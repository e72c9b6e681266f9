"""Row-level quality rules: one projection that annotates, whatever the number of rules."""

from __future__ import annotations

import dataclasses
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomwork.functions.scalars import falsy

# fixed values: the messages' wording
MISSING = "Missing required field: {}"
NULL = "Null value in field: {}"
FORMAT = "Invalid format in field {}"
BELOW = "Value {} below minimum {} in field {}"
ABOVE = "Value {} above maximum {} in field {}"


@dataclasses.dataclass(frozen=True)
class Rule:
    """``kind``: required, not_null, regex or range; others never fail."""

    kind: str
    field: str
    pattern: str = ""
    low: float | None = None
    high: float | None = None


DEFAULT_RULES = (Rule("required", "member_number"), Rule("not_null", "member_number"))


def _failures(df: DataFrame, rule: Rule) -> list[Column]:
    name, col = rule.field, F.col(f"`{rule.field}`") if rule.field in df.columns else F.lit(None)
    if rule.kind == "required":
        return [F.when(falsy(df, name), MISSING.format(name))]
    if rule.kind == "not_null":
        return [F.when(col.isNull(), NULL.format(name))]
    if rule.kind == "regex":
        return [F.when(~falsy(df, name) & ~col.cast("string").rlike(f"^(?:{rule.pattern})"), FORMAT.format(name))]
    if rule.kind == "range" and name in df.columns:
        kind = df.schema[name].dataType
        number = col if isinstance(kind, T.NumericType) else col.try_cast("double")
        # NaN compares as false both ways
        real = ~F.isnan(number) if isinstance(kind, (T.DoubleType, T.FloatType)) or not isinstance(kind, T.NumericType) else F.lit(True)
        said = col.cast("string")
        text = lambda shape, bound: F.concat(F.lit(shape.partition("{}")[0]), said, F.lit(shape.partition("{}")[2].format(bound, name)))
        out = []
        if rule.low is not None:
            out.append(F.when(real & (number < rule.low), text(BELOW, rule.low)))
        if rule.high is not None:
            out.append(F.when(real & (number > rule.high), text(ABOVE, rule.high)))
        return out
    return []


def annotate(df: DataFrame, rules: Sequence[Rule] = DEFAULT_RULES) -> DataFrame:
    """Adds ``_dq_status`` and, where failed, ``_dq_errors`` in rule order; drops nothing."""
    failures = [c.cast("string") for rule in rules for c in _failures(df, rule)]
    errors = F.array_compact(F.array(*failures)) if failures else F.array().cast("array<string>")
    out = df.withColumn("_dq_errors", errors)
    failed = F.size("_dq_errors") > 0
    return out.withColumn("_dq_status", F.when(failed, "FAILED").otherwise("PASSED")).withColumn("_dq_errors", F.when(failed, F.col("_dq_errors")))


def split(annotated: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(passed, failed)."""
    return annotated.where("_dq_status = 'PASSED'"), annotated.where("_dq_status = 'FAILED'")


def _counts(annotated: DataFrame, not_null: Sequence[str]) -> list[Column]:
    nulls = sum((F.count_if(F.col(f"`{c}`").isNull()) for c in not_null if c in annotated.columns), F.lit(0).cast("long"))
    return [
        F.count("*").alias("records_processed"),
        F.coalesce(F.sum(F.coalesce(F.array_size("_dq_errors"), F.lit(0))), F.lit(0)).cast("long").alias("dq_errors"),
        F.count_if(F.col("_dq_status") == "PASSED").alias("dq_passed"),
        nulls.cast("long").alias("null_values"),
    ]


def counters(annotated: DataFrame, not_null: Sequence[str] = ("member_number",)) -> DataFrame:
    """One row: rows, errors (one for each message), successes and nulls of the not_null fields."""
    return annotated.agg(*_counts(annotated, not_null))


def observed(annotated: DataFrame, observation: Observation | str, not_null: Sequence[str] = ("member_number",)) -> DataFrame:
    """``annotated`` itself; the same counters are taken as its rows pass by, with no second pass, and are in
    ``observation.get`` after the first action, or, under a name, in the progress of a stream."""
    return annotated.observe(observation, *_counts(annotated, not_null))
