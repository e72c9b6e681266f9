"""A corpus pipeline over ``documents``: toxicity, line dedup, near-dedup, decontamination, tokens.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor kept; all but the last return the columns
of ``documents``. ``run`` writes each stage's result to the shared folder and reads it again for the next.

In every stage null and empty texts pass as texts without words, lines or tokens, with one exception: near-dedup takes all
rows without words as copies of each other and keeps the one of the smallest id, which includes documents that line dedup
has emptied. Rows of one id are judged each by its own text; near-dedup keeps the first of equal ones. Columns besides
``doc_id`` and ``text`` are carried along, whatever their names.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomwork.llm import bpe, decontaminate, lines, shingles, toxicity
from loomwork.llm._common import written

#: No stage but decontamination is expressible in SQL; tests hold the rest against brute force.
ORACLE_SQL = None


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go; empty and null ones have a score too."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic")
    return toxicity.without_toxic(docs, toxicity.train(docs, labels))


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that match an earlier one go; ``n_chars`` follows. A document keeps its row even if no line is left;
    near-dedup then keeps one of such rows."""
    cut = lines.without_lines(docs).withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return cut.select(docs.columns)


def dedup_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (0.8 or more of their five-word shingles shared) stays."""
    return shingles.one_of_each(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with benchmark windows over a twentieth of their words go; those without words stay."""
    return decontaminate.without_documents(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256, ids) of each row, no ids for null and empty texts."""
    return bpe.round_trip(docs, public_tokenizers.path("word_bpe_49k.json"), ids=True)


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", dedup_lines),
    ("near_dedup", dedup_documents),
    ("decontamination", drop_contaminated),
    ("bpe", tokenize),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
