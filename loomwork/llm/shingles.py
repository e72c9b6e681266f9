"""Near-dedup by SimHash, and by the Jaccard similarity of documents' sets of word shingles.

Documents with the same set are one node from the start. Nodes are linked by their SimHash fingerprints first: those of
the same fingerprint, and those that the Gray-order index of ``simhash`` finds within two bits. Each such pair is
verified on the whole shingle sets, which are exact up to collisions of 64-bit hashes.

SimHash alone can't find pairs down to a similarity of 0.8: they lie about 10 of 64 bits apart, beyond what an index of
masks can search. What it leaves apart goes on: further candidates share a band of ROWS min-hashes, with so many bands
that a pair of just the wanted similarity is missed with a probability of MISSED at most, and more similar ones less.
These are verified in the same way.

In a bucket (the nodes of one band value) members are first compared with one leader; pairs within a component, that of
SimHash's links to begin with, need no comparison, and once few pairs of different components are left all of them are
compared. So large groups of near copies cost little, and no pair is left out.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomwork.llm import simhash
from loomwork.llm._common import in_arrow, inside, mapped, renamed, text_bytes, written
from loomwork.llm.components import ROW, connected_components, first_of_each, nodes_of, numbered

SEED = 42
#: Min-hashes of a band.
ROWS = 5
#: Probability of missing a pair of just the wanted similarity.
MISSED = 1e-6
#: Rounds with one leader a bucket, at most, and pairs for each bucket entry from which on all are compared.
LEADERS = 6
FEW = 4


def shingle_set(text: bytes, width: int) -> np.ndarray:
    """The sorted distinct hashes of a text's word shingles: A-Z is lower-cased, words are separated by ASCII white
    space, a text of fewer words has one shingle and one without words none."""
    words = text.lower().split()  # bytes: A-Z only, and only ASCII white space
    if not words:
        return np.zeros(0, np.uint64)
    xxh, join = xxhash.xxh64_intdigest, b" ".join
    if len(words) <= width:
        return np.array([xxh(join(words), SEED)], np.uint64)
    return np.unique(np.fromiter((xxh(join(s), SEED) for s in zip(*[words[i:] for i in range(width)])), np.uint64))  # noqa: B905


def bands_for(similarity: float) -> int:
    hit = similarity**ROWS
    return 1 if hit >= 1 else math.ceil(math.log(MISSED) / math.log1p(-hit))


def band_values(hashes: np.ndarray, factors: np.ndarray, shifts: np.ndarray) -> list[int]:
    """One value for each band of min-hashes of a set that isn't empty."""
    least = np.full(len(factors), ~np.uint64(0))
    for at in range(0, len(hashes), 2048):
        least = np.minimum(least, (factors[:, None] * hashes[at : at + 2048] + shifts[:, None]).min(1))
    return [xxhash.xxh64_intdigest(row.tobytes(), i) for i, row in enumerate(least.reshape(-1, ROWS))]


def _signatures(rows: DataFrame, width: int, similarity: float) -> DataFrame:
    """(ROW, key, bands, fp): the hash of each row's set, its band values (none for an empty set), and its SimHash."""
    rng = np.random.default_rng(SEED)
    n = ROWS * bands_for(similarity)
    factors, shifts = (rng.integers(0, 1 << 64, n, np.uint64) for _ in range(2))
    factors |= np.uint64(1)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingle_set(text, width) for text in text_bytes(batch["text"])]
            keys = pa.array([xxhash.xxh128_digest(s.tobytes()) for s in sets], pa.binary())
            values = [np.array(band_values(s, factors, shifts) if len(s) else [], np.uint64).view(np.int64) for s in sets]
            fps = np.fromiter(map(simhash.fingerprint, text_bytes(batch["text"])), np.uint64, batch.num_rows)
            columns = [batch[ROW], keys, pa.array(values, pa.list_(pa.int64())), pa.array(fps.view(np.int64))]
            yield pa.RecordBatch.from_arrays(columns, [ROW, "key", "bands", "fp"])

    return in_arrow(rows.select(ROW, "text"), work, f"{ROW} long, key binary, bands array<long>, fp long")


def _verified(pairs: DataFrame, rows: DataFrame, width: int, similarity: float) -> DataFrame:
    """The ``pairs`` (a, b) of row numbers whose sets are similar."""
    named = mapped(pairs.select(F.explode(F.array("a", "b")).alias("node")), F.col("node"))
    texts = inside(rows.select(ROW, "text"), named, F.col(ROW))
    both = pairs.join(texts.select(F.col(ROW).alias("b"), F.col("text").alias("text_b")), "b").join(texts.select(F.col(ROW).alias("a"), F.col("text").alias("text_a")), "a")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            known: dict[int, np.ndarray] = {}
            keep = []
            for a, b, x, y in zip(batch["a"].to_pylist(), batch["b"].to_pylist(), text_bytes(batch["text_a"]), text_bytes(batch["text_b"]), strict=True):
                for k, text in ((a, x), (b, y)):
                    if k not in known:
                        known[k] = shingle_set(text, width)
                shared = len(np.intersect1d(known[a], known[b], assume_unique=True))
                keep.append(shared >= similarity * (len(known[a]) + len(known[b]) - shared) - 1e-9)
            yield pa.RecordBatch.from_arrays([batch["a"], batch["b"]], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return in_arrow(both.select("a", "b", "text_a", "text_b"), work, "a long, b long")


def _fingerprint_pairs(fps: DataFrame) -> DataFrame:
    """(a, b): the nodes of (node, fp) that SimHash links. Each node of a fingerprint is paired with the first one, and the
    first ones of fingerprints within two bits with each other, so pairs don't grow with the square of a group."""
    firsts = written(fps.groupBy("fp").agg(F.min("node").alias("first")), "near-fingerprints")
    same = fps.join(firsts, "fp").where("node <> first").select(F.col("first").alias("a"), F.col("node").alias("b"))
    ends = firsts.select("fp", "first")
    near = simhash.links(firsts.select("fp")).toDF("x", "y").join(ends.toDF("x", "n"), "x").join(ends.toDF("y", "m"), "y")
    return same.unionByName(near.select(F.least("n", "m").alias("a"), F.greatest("n", "m").alias("b")))


def _links(buckets: DataFrame, rows: DataFrame, width: int, similarity: float, edges: DataFrame, tested: DataFrame) -> DataFrame:
    """(a, b): ``edges`` and the similar pairs that connect all nodes of ``buckets`` (band, node) which similar candidates
    connect. Pairs of ``tested`` aren't verified again."""
    entries = buckets.count()
    for turn in range(LEADERS + 1):
        open_ = buckets.join(connected_components(edges), "node", "left").select("band", "node", F.coalesce("component", "node").alias("c"))
        sizes = open_.groupBy("band", "c").agg(F.count("*").alias("n")).groupBy("band")
        sizes = sizes.agg(((F.sum("n") * F.sum("n") - F.sum(F.col("n") * F.col("n"))) / 2).alias("pairs")).where("pairs > 0")
        left = sizes.agg(F.sum("pairs")).first()[0] or 0
        if not left:
            break
        open_ = open_.join(sizes.select("band"), "band", "left_semi")
        last = turn == LEADERS or (turn > 0 and left <= FEW * entries)
        if last:
            others = open_.select("band", F.col("node").alias("lead"), F.col("c").alias("lead_c"))
        else:
            others = open_.groupBy("band").agg(F.min(F.struct(F.xxhash64("node", F.lit(turn)), "node", "c")).alias("lead"))
            others = others.select("band", F.col("lead.node").alias("lead"), F.col("lead.c").alias("lead_c"))
        met = open_.join(others, "band").where("c <> lead_c")
        pairs = met.select(F.least("node", "lead").alias("a"), F.greatest("node", "lead").alias("b")).distinct()
        pairs = written(pairs.join(tested, ["a", "b"], "left_anti"), "near-candidates")
        found = written(_verified(pairs, rows, width, similarity), "near-links")
        edges, tested = edges.unionByName(found), tested.unionByName(pairs)
        if last:
            break
    return edges


def one_of_each(docs: DataFrame, width: int = 5, similarity: float = 0.8) -> DataFrame:
    """``docs`` with one row of each group that pairs of ``similarity`` or more connect, as SimHash links them and as
    min-hashes find them beyond its two bits: that of the smallest doc_id,
    rows without one last, and of rows with the same id one only. Texts without words, null ones too, are one group."""
    whole, row = numbered(docs)
    rows = renamed(whole, doc_id="doc_id", text="text", **{ROW: row})
    signed = written(_signatures(rows, width, similarity).join(rows.select(ROW, "doc_id"), ROW), "near-signatures")
    nodes = written(nodes_of(signed), "near-nodes")
    own = signed.join(nodes.select(F.col("node").alias(ROW)), ROW, "left_semi")
    tested = written(_fingerprint_pairs(own.select(F.col(ROW).alias("node"), "fp")), "near-candidates")
    linked = written(_verified(tested, rows, width, similarity), "near-links")
    filed = own.select(F.explode("bands").alias("band"), F.col(ROW).alias("node"))
    shared = filed.groupBy("band").agg(F.count("*").alias("n")).where("n > 1").select("band")
    buckets = written(filed.join(shared, "band", "left_semi"), "near-buckets")
    return first_of_each(whole, row, nodes, _links(buckets, rows, width, similarity, linked, tested))
