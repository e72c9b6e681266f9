"""The subpackage's registered queries: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomwork.llm import alignment, bpe, context_tree, decontaminate, jpeg, lines, resampling, simhash, substring, token_files, toxicity, urls, warc
from loomwork.llm._common import table, written

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
BYTE_LEVEL = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents", "doc_id", "text"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text", "lang")
    return toxicity.judged(docs, toxicity.train(docs, table(spark, sf_dir, "labels", "doc_id", "toxic")))


def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.read_digests(token_files.write(table(spark, sf_dir, "documents", "doc_id", "text"), TOKENIZER))


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(table(spark, sf_dir, "documents", "doc_id", "text"), TOKENIZER)


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.hits(table(spark, sf_dir, "documents", "doc_id", "text"), table(spark, sf_dir, "benchmark"))
    return decontaminate.judged(found).select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def op6_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = lines.without_lines(table(spark, sf_dir, "documents", "doc_id", "text"))
    return cut.select("doc_id", "n_lines", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


def op7_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judged(table(spark, sf_dir, "pages", "page_id", "url"))


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    archive = warc.write(table(spark, sf_dir, "pages", "page_id", "url", "html"), min_bytes=0)
    records = warc.read(archive)
    return records.select("page_id", "payload_bytes", F.col("stored_digest").alias("payload_digest"), "record_type", "refers_to", F.sha2(warc.record_of(), 256).alias("record_sha256"))


def op9_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.digests(table(spark, sf_dir, "documents", "doc_id", "text"))


def op10_jpeg(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jpeg.described(written(jpeg.stored(table(spark, sf_dir, "documents", "doc_id", "text")), "media"))


def op11_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampling.importance(table(spark, sf_dir, "documents", "doc_id", "text"), table(spark, sf_dir, "benchmark"))


def op12_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.aligned(table(spark, sf_dir, "documents", "doc_id", "text"), BYTE_LEVEL, PIECES)


def op13_context_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return context_tree.scored(table(spark, sf_dir, "documents", "doc_id", "text"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_simhash, op2_toxicity, op3_token_files, op4_bpe, op5_decontaminate, op6_lines, op7_urls, op8_warc, op9_substring, op10_jpeg, op11_resample, op12_align, op13_context_tree)}
