"""Branches, error routes and step chains: all plain filters and ``DataFrame.transform``."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomwork.functions.scalars import falsy

Step = Callable[[DataFrame], DataFrame]


def branches(df: DataFrame, conditions: dict[str, str | None]) -> dict[str, DataFrame]:
    """A frame for each name; conditions are SQL and may overlap, and none takes all rows."""
    return {name: df if cond is None else df.where(F.expr(cond)) for name, cond in conditions.items()}


def main_branch(df: DataFrame, conditions: dict[str, str | None], name: str = "main") -> DataFrame:
    return branches(df, conditions).get(name, df)


def error_routes(df: DataFrame, as_of: Column, max_share: float | None = None) -> tuple[DataFrame, DataFrame]:
    """(success, errors): rows with a truthy ``_error`` become (record, error, timestamp), where the record is the whole
    row; the others stay as they are. A larger share of errors
    than ``max_share`` raises, at the cost of one count."""
    bad = ~falsy(df, "_error")
    if max_share is not None:
        n, wrong = df.agg(F.count("*"), F.count_if(bad)).first()
        if n and wrong / n > max_share:
            raise ValueError(f"{wrong} of {n} rows are errors")
    errors = df.where(bad).select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("record"), F.col("_error").alias("error"), as_of.alias("timestamp"))
    return df.where(~bad), errors


def without_metadata(df: DataFrame) -> DataFrame:
    """Drops the columns whose names start with an underscore."""
    return df.select([F.col(f"`{c}`") for c in df.columns if not c.startswith("_")])


def chained(df: DataFrame, steps: Iterable[Step | tuple[Step, bool]]) -> DataFrame:
    """Steps in order, each on the one before; (step, False) is passed over. Other things raise."""

    def apply(d: DataFrame, step) -> DataFrame:
        run, enabled = step if isinstance(step, tuple) else (step, True)
        if not callable(run):
            raise TypeError(f"not a step: {run!r}")
        return d.transform(run) if enabled else d

    return reduce(apply, steps, df)
