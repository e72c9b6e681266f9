"""Importance resampling towards a target distribution, on hashed word n-gram buckets.

Features are all runs of 1 to ``ORDER`` consecutive words, joined by one space; a feature's bucket is the CRC-32 of its
bytes modulo ``BUCKETS``. Both corpora are counted by bucket over all their texts. A document's weight is the sum of its
features' gains, and a Gumbel term drawn from its id turns the highest scores into a sample without replacement.

The CRC of a span isn't run byte by byte. It is linear: each byte adds a term that depends on the byte and its distance
from the span's end alone. A table of these terms (``PositionTable``) is gathered for all bytes of all spans of a group
of texts, XORed by ``bitwise_xor.reduceat`` over the spans, and a constant for the span's length is added. Spans longer
than ``BLOCK`` bytes fold block by block: the register so far is advanced over a block's zeros and the block is added.

Words are runs of the bytes ``0-9 a-z 0x80-0xFF`` after lower-casing A-Z. A null or empty text has no features and
weight 0. Rows of a null doc_id have no draw: their score is null and they are never taken, nor counted among those that
are drawn from. Repeated ids are rows of their own with one draw; equal scores go by doc_id, then by the number of
features. An empty target or an empty table of documents is counted as zeros. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loomwork.llm._common import WORD_TABLE, in_arrow, renamed, text_bytes, written
from loomwork.llm.components import numbered

BUCKETS = 10_000
ORDER = 3
#: Distances from a span's end that the table has terms for.
BLOCK = 64
#: Spans that are gathered at once, and bytes of the texts that are looked at together.
SPANS = 1 << 15
GROUP_BYTES = 1 << 19
ONES = 0xFFFFFFFF


class PositionTable:
    """CRC-32 of many spans of a byte array at once."""

    def __init__(self, block: int = BLOCK):
        self.block = block
        zeros = [zlib.crc32(bytes(n)) for n in range(block + 1)]
        #: by distance from the end, then byte
        self.terms = np.array([zlib.crc32(bytes([b]) + bytes(d)) ^ zeros[d + 1] for d in range(block) for b in range(256)], np.uint32)
        #: the register after so many zeros
        self.constant = np.array(zeros, np.uint32) ^ np.uint32(ONES)
        # a register, byte by byte, moved on over a block of zeros
        self.moved = np.array([[zlib.crc32(bytes(block), (x << 8 * k) ^ ONES) ^ ONES for x in range(256)] for k in range(4)], np.uint32)

    def _folded(self, data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """The XOR of the terms of each span, of 1 to ``block`` bytes."""
        out = np.empty(len(starts), np.uint32)
        for a in range(0, len(starts), SPANS):
            start, n = starts[a : a + SPANS], lengths[a : a + SPANS]
            stop = np.cumsum(n)
            begin = stop - n
            flat = np.arange(stop[-1])
            place = flat + np.repeat(start - begin, n)
            distance = np.repeat(stop - 1, n) - flat
            out[a : a + SPANS] = np.bitwise_xor.reduceat(self.terms[(distance << 8) | data[place]], begin)
        return out

    def _advanced(self, register: np.ndarray) -> np.ndarray:
        out = self.moved[0][register & 0xFF]
        for k in (1, 2, 3):
            out ^= self.moved[k][(register >> np.uint32(8 * k)) & 0xFF]
        return out

    def crc(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Of ``data[start:end]`` for each span; no span is empty."""
        n = ends - starts
        first = (n - 1) % self.block + 1
        register = self._folded(data, starts, first) ^ self.constant[first]
        longer = np.flatnonzero(n > self.block)
        place = starts[longer] + first[longer]
        while len(longer):
            register[longer] = self._advanced(register[longer]) ^ self._folded(data, place, np.full(len(place), self.block))
            place = place + self.block
            more = place < ends[longer]
            longer, place = longer[more], place[more]
        return register ^ np.uint32(ONES)


def _parts(texts: Iterator[bytes], order: int) -> Iterator[tuple[int, bytes, int]]:
    """(row, words, own): texts with spaces between words, cut at words if they are long. Features that start within
    the first ``own`` bytes are the part's; what follows is there for them to end in."""
    for row, text in enumerate(texts):
        said = text.translate(WORD_TABLE)
        at = 0
        while len(said) - at > GROUP_BYTES:
            cut = said.find(b" ", at + GROUP_BYTES)
            if cut < 0:
                break
            end = cut
            for _ in range(order - 1):
                while end < len(said) and said[end] == 0x20:
                    end += 1
                end = said.find(b" ", end)
                if end < 0:
                    end = len(said)
            yield row, said[at:end], cut - at
            at = cut
        yield row, said[at:], len(said) - at


def _groups(texts: Iterator[bytes], order: int) -> Iterator[list[tuple[int, bytes, int]]]:
    group, size = [], 0
    for part in _parts(texts, order):
        group.append(part)
        size += len(part[1]) + 1
        if size >= GROUP_BYTES:
            yield group
            group, size = [], 0
    if group:
        yield group


class Features:
    """Buckets of the features of texts."""

    def __init__(self, buckets: int = BUCKETS, order: int = ORDER):
        self.table, self.buckets, self.order = PositionTable(), buckets, order

    def of(self, texts: Iterator[bytes]) -> Iterator[tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray]]]]:
        """For each group of texts the row of each of its words, and (rows, buckets) of its features by length."""
        for group in _groups(texts, self.order):
            raw = np.frombuffer(b" ".join(p for _, p, _ in group) + b" ", np.uint8)
            word = np.concatenate(([False], raw != 0x20))
            edges = np.flatnonzero(word[1:] != word[:-1])
            begin, n = edges[::2], edges[1::2] - edges[::2]
            data = raw[word[1:] | word[:-1]]  # each word and one space
            end = np.cumsum(n + 1) - 1
            start = end - n
            size = np.array([len(p) + 1 for _, p, _ in group])
            till = np.cumsum(size)
            part = np.searchsorted(till, begin, "right")
            own = begin < (till - size + np.array([o for *_, o in group]))[part]
            row = np.array([r for r, *_ in group])[part]
            found = []
            for k in range(1, self.order + 1):
                last = len(begin) - k + 1
                if last <= 0:
                    break
                at = np.flatnonzero(own[:last] & (part[:last] == part[k - 1 :]))
                if len(at):
                    found.append((row[at], self.table.crc(data, start[at], end[at + k - 1]) % self.buckets))
            yield row[own], found


def bucket_counts(docs: DataFrame, buckets: int = BUCKETS, order: int = ORDER) -> DataFrame:
    """(bucket, n): features of all texts, added up in each task before they are dealt out."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features, total = Features(buckets, order), np.zeros(buckets, np.int64)
        for batch in batches:
            for _, found in features.of(text_bytes(batch["text"])):
                for _, b in found:
                    total += np.bincount(b, minlength=buckets)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(total[at], pa.int64())], ["bucket", "n"])

    return in_arrow(docs.select("text"), work, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(docs: DataFrame, target: DataFrame, buckets: int = BUCKETS, order: int = ORDER) -> np.ndarray:
    """floor(1000 ln(target's smoothed share / the corpus's)) of each bucket; one row a bucket comes to the driver."""
    counts = [np.zeros(buckets, object), np.zeros(buckets, object)]
    for at, df in enumerate((docs, target)):
        for bucket, n in bucket_counts(df, buckets, order).collect():
            counts[at][bucket] = n
    ours, theirs = counts
    S, T = sum(ours), sum(theirs)
    return np.array([math.floor(1000 * math.log((t + 1) * (S + buckets) / ((s + 1) * (T + buckets)))) for s, t in zip(ours, theirs, strict=True)], np.float64)


def gumbel(doc_id: object, seed: int) -> int:
    """A draw from the id alone: the same in any order and on any machine."""
    h = int(hashlib.sha256(f"{seed}:{doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def weighed(docs: DataFrame, gain: np.ndarray, seed: int = 42, order: int = ORDER, keep: Sequence[str] = ()) -> DataFrame:
    """(doc_id, n_words, n_features, weight, score) and the columns of ``keep``; the weight is exact in doubles up to 2^53."""
    names = ["doc_id", *keep]
    kinds = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in names)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = Features(len(gain), order)
        for batch in batches:
            rows = batch.num_rows
            n_words, n_features, weight = np.zeros(rows, np.int64), np.zeros(rows, np.int64), np.zeros(rows)
            for words, found in features.of(text_bytes(batch["text"])):
                n_words += np.bincount(words, minlength=rows)
                for row, b in found:
                    n_features += np.bincount(row, minlength=rows)
                    weight += np.bincount(row, gain[b], rows)
            whole = weight.astype(np.int64)
            score = [None if i is None else w + gumbel(i, seed) for i, w in zip(batch["doc_id"].to_pylist(), whole.tolist(), strict=True)]
            numbers = [pa.array(n_words), pa.array(n_features), pa.array(whole), pa.array(score, pa.int64())]
            yield pa.RecordBatch.from_arrays([*(batch[c] for c in names), *numbers], [*names, "n_words", "n_features", "weight", "score"])

    return in_arrow(docs.select(*names, "text"), work, f"{kinds}, n_words long, n_features long, weight long, score long")


def ranked(scored: DataFrame, percent: int = 5, least_words: int = 20) -> DataFrame:
    """``scored`` with ``rank``: 1, 2, 3, ... for the ``percent`` of highest score among rows of at least ``least_words``
    words, null for the rest.

    One sort over the cluster by ranges of the score; a row's rank is its place in its range and the number of rows in
    the ranges before. So no task holds more than its range, whatever the number of ranks."""
    apt = F.coalesce((F.col("n_words") >= least_words) & F.col("score").isNotNull(), F.lit(False))
    order = [F.desc("_apt"), F.desc("score"), F.asc("doc_id"), F.asc("n_features")]
    dealt = scored.withColumn("_apt", apt).repartitionByRange(*order).sortWithinPartitions(*order)
    placed = written(dealt.withColumns({"_part": F.spark_partition_id(), "_at": F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)}), "ranges")
    parts = placed.groupBy("_part").agg(F.count("*").alias("rows"), F.count_if("_apt").alias("apt"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # a row a range
    whole = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    offsets = parts.select("_part", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("_before"), F.floor(F.sum("apt").over(whole) * percent / 100).alias("_drawn"))
    place = F.col("_before") + F.col("_at") + 1
    return placed.join(offsets, "_part").withColumn("rank", F.when(F.col("_apt") & (place <= F.col("_drawn")), place)).drop("_part", "_at", "_apt", "_before", "_drawn")


def importance(docs: DataFrame, target: DataFrame, percent: int = 5, seed: int = 42, least_words: int = 20, buckets: int = BUCKETS, order: int = ORDER) -> DataFrame:
    """(doc_id, n_features, weight, score, rank) of every row."""
    slim = renamed(docs, doc_id="doc_id", text="text")
    return ranked(weighed(slim, gains(slim, target, buckets, order), seed, order), percent, least_words).select("doc_id", "n_features", "weight", "score", "rank")


def resampled(docs: DataFrame, target: DataFrame, percent: int = 5, seed: int = 42, least_words: int = 20) -> DataFrame:
    """The drawn rows of ``docs``, all columns as they are."""
    rows, row = numbered(docs)
    slim = renamed(rows, doc_id="doc_id", text="text", row=row)
    drawn = ranked(weighed(slim, gains(slim, target), seed, keep=["row"]), percent, least_words).where("rank is not null")
    return rows.join(drawn.select(F.col("row").alias(row)), row, "left_semi").drop(row)
