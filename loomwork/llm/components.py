"""Connected components of an edge table, by alternating large-star and small-star rounds on DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomwork.llm._common import written


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component): the smallest node that each node of ``edges`` (a, b) reaches.

    Nothing is collected but one count and checksum a round; rounds grow with the logarithm of the longest path.
    Each round's edges are checkpointed, so plans stay short and a lost executor costs one round at most. Edges
    with a null end are dropped.
    """
    pairs = edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct().checkpoint()
    seen = None
    while True:
        now = tuple(pairs.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if now == seen:
            return pairs.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
                pairs.select(F.col("v").alias("node"), F.col("v").alias("component"))
            ).distinct()
        seen = now
        pairs = _small_star(_large_star(pairs)).checkpoint()


def _large_star(pairs: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the node's smallest neighbour, itself included."""
    both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(pairs: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node, is linked to the smallest of them."""
    least = pairs.groupBy("u").agg(F.min("v").alias("m"))
    moved = pairs.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).where("u <> v").distinct()


#: The column that numbers rows in tables of an operator's own columns.
ROW = "_row"


def numbered(docs: DataFrame) -> tuple[DataFrame, str]:
    """``docs`` in the shared folder with a number for each row, so that rows are told apart whatever their ids, and the
    name of that column, which none of ``docs`` has."""
    taken, row = {c.lower() for c in docs.columns}, ROW
    while row in taken:
        row = f"_{row}"
    return written(docs.withColumn(row, F.monotonically_increasing_id()), "documents-by-row"), row


def nodes_of(keyed: DataFrame) -> DataFrame:
    """(key, best, node) for each key of (doc_id, ROW, key): its first row, by doc_id with nulls last, then by number."""
    best = F.min(F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", ROW)).alias("best")
    return keyed.groupBy("key").agg(best).withColumn("node", F.col(f"best.{ROW}"))


def first_of_each(rows: DataFrame, row: str, nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """The ``rows``, numbered by ``row``, that are first in their component of ``edges`` (a, b) between ``nodes``."""
    labelled = nodes.join(connected_components(edges), "node", "left")
    stay = labelled.groupBy(F.coalesce("component", "node")).agg(F.min("best").alias("best")).select(F.col(f"best.{ROW}").alias(row))
    return rows.join(stay, row, "left_semi").drop(row)
