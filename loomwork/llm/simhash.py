"""SimHash near-dedup with a Gray-order hierarchical index.

``fingerprints`` gives one 64-bit fingerprint a document. ``links`` finds all pairs of distinct fingerprints that
differ in at most two bits. The index's upper nodes are shared masked bit patterns: of four bit chunks at least two
are free of differences, so each fingerprint is filed under the six masks that keep two chunks. All filed fingerprints
are put in one order over the cluster: by mask, then by the Gray rank of the pattern under it, then by their own. A node
is a run of one pattern, and the tasks read the runs as they come, in Gray order, which puts those with common bits
together. Within a node, runs of fingerprints become nodes with the bits they share, and the search descends on pairs of
nodes, adding up differences on shared bits and leaving out whole groups once these pass the limit.

A node of more than NODE fingerprints is handed back and filed under six finer masks over the bits that it doesn't
share, twice at most: then 56 bits are shared and at most 256 fingerprints remain, so no node is unbounded whatever the
data, and none is dropped. A finer level is planned only if there is such a node.

Work on groups of copies: fingerprints are made distinct first, so copies cost nothing here, and a fingerprint has
at most 2080 others within two bits, so links never grow with the square of a group.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomwork.llm._common import in_arrow, renamed, text_bytes, written
from loomwork.llm.components import ROW, connected_components, first_of_each, nodes_of, numbered

#: Fingerprints that one index node may hold before it is split by a finer mask; 256 at least.
NODE = 512
#: Children of a node in the tree within one index node.
FAN = 8
SEED = 42


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3) -> DataFrame:
    """(doc_id, fp): the SimHash of each whole text's word shingles, repeats counted. A-Z is lower-cased and words
    are separated by ASCII white space; a text of fewer words has one shingle, and one without words, as a null
    text, has fingerprint zero."""
    kind = docs.schema[id_col].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = np.fromiter((fingerprint(text, width) for text in text_bytes(batch["text"])), np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(out.view(np.int64))], ["doc_id", "fp"])

    return in_arrow(renamed(docs, doc_id=id_col, text=text_col), work, f"doc_id {kind}, fp long")


def fingerprint(text: bytes, width: int = 3) -> int:
    """The SimHash of one text."""
    words = text.lower().split()  # bytes: A-Z only, and only ASCII white space
    if not words:
        return 0
    xxh, join = xxhash.xxh64_intdigest, b" ".join
    if len(words) <= width:
        return xxh(join(words), SEED)
    hashes = np.fromiter((xxh(join(s), SEED) for s in zip(*[words[i:] for i in range(width)])), np.uint64)  # noqa: B905
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 14):
        block = hashes[at : at + (1 << 14)]
        ones += np.unpackbits(block.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(hashes), bitorder="little").view(np.uint64)[0])


def gray_rank(codes: np.ndarray) -> np.ndarray:
    """Where each code stands in Gray order."""
    rank = codes.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(shift)
    return rank


def node_links(codes: np.ndarray, limit: int = 2) -> tuple[np.ndarray, np.ndarray]:
    """All pairs of the distinct codes of one index node, in Gray order, that differ in at most ``limit`` bits."""
    # a level of the tree: for each run of FAN nodes, the bits they share (mask) and their values (pattern)
    levels = [(np.full(len(codes), ~np.uint64(0)), codes)]
    while len(levels[-1][0]) > 1:
        mask, pattern = levels[-1]
        starts = np.arange(0, len(mask), FAN)
        every, some = np.bitwise_and.reduceat(pattern | ~mask, starts), np.bitwise_or.reduceat(pattern & mask, starts)
        shared = np.bitwise_and.reduceat(mask, starts) & ~(every ^ some)
        levels.append((shared, some & shared))
    a = b = np.zeros(1, np.int64)
    seen, apart = np.zeros(1, np.uint64), np.zeros(1, np.int64)  # of each pair: bits compared, differences so far
    for mask, pattern in reversed(levels[:-1]):
        step = np.arange(FAN)
        a, b = (np.broadcast_to(x, (len(a), FAN, FAN)).ravel() for x in ((a[:, None] * FAN + step)[:, :, None], (b[:, None] * FAN + step)[:, None, :]))
        seen, apart = np.repeat(seen, FAN * FAN), np.repeat(apart, FAN * FAN)
        keep = (a <= b) & (b < len(mask))
        a, b, seen, apart = a[keep], b[keep], seen[keep], apart[keep]
        both = mask[a] & mask[b]
        apart = apart + np.bitwise_count((pattern[a] ^ pattern[b]) & both & ~seen)
        keep = apart <= limit
        a, b, seen, apart = a[keep], b[keep], both[keep], apart[keep]
    keep = a < b
    return codes[a[keep]], codes[b[keep]]


def _masks(chunks: list[int]) -> list[int]:
    """Every union of two of the four masks."""
    return [chunks[i] | chunks[j] for i in range(4) for j in range(i + 1, 4)]


def _filed(fps: DataFrame) -> DataFrame:
    """Each fingerprint under the six masks that keep two of the four 16-bit chunks."""
    choices = F.array(*[F.lit(_signed(m)) for m in _masks([0xFFFF << 16 * i for i in range(4)])])
    return fps.select("fp", F.explode(choices).alias("mask"))


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _rank(code: Column) -> Column:
    """``gray_rank`` as an expression."""
    for shift in (1, 2, 4, 8, 16, 32):
        code = code.bitwiseXOR(F.shiftrightunsigned(code, shift))
    return code


def _in_gray_order(filed: DataFrame) -> DataFrame:
    """(fp, mask) by mask, Gray rank of the pattern and Gray rank; the fingerprints of a node are in one partition."""
    ranked = filed.select("fp", "mask", _rank(F.col("fp").bitwiseAND(F.col("mask"))).alias("node"), _rank(F.col("fp")).alias("rank"))
    return ranked.repartitionByRange("mask", "node").sortWithinPartitions("mask", "node", "rank").select("fp", "mask")


def links(fps: DataFrame) -> DataFrame:
    """(a, b) with a < b: all pairs of the distinct non-null fingerprints ``fp`` that differ in one or two bits."""
    found, filed, size = None, _filed(fps), 16
    while True:
        searched = written(_searched(_in_gray_order(filed), NODE), "fingerprint-pairs")
        pairs, large = searched.where("held is null").select("a", "b"), searched.where("held is not null")
        found = pairs if found is None else found.unionByName(pairs)
        # nodes that share 56 bits hold 256 fingerprints at most
        if size == 4 or large.isEmpty():
            return found.distinct()
        size //= 2
        filed = _filed_below(large.select(F.col("a").alias("fp"), "held"), size)


def _filed_below(large: DataFrame, size: int) -> DataFrame:
    """Each (fp, held) under the six finer masks: the two free chunks of ``held`` are halved, and two of the four
    halves kept."""
    chunk = lambda at: F.lit(_signed(((1 << size) - 1) << at))
    starts = range(0, 64, 2 * size)
    free = F.flatten(F.array(*[F.when(F.col("held").bitwiseAND(chunk(at)) == 0, F.array(chunk(at), chunk(at + size))).otherwise(F.array().cast("array<long>")) for at in starts]))
    halves = large.withColumn("free", free)
    choices = F.array(*[F.col("held").bitwiseOR(F.col("free")[i]).bitwiseOR(F.col("free")[j]) for i in range(4) for j in range(i + 1, 4)])
    return halves.select("fp", F.explode(choices).alias("mask")).distinct()


def _searched(ordered: DataFrame, most: int) -> DataFrame:
    """(a, b, held): the pairs of every node of up to ``most`` fingerprints, with no ``held``, and the fingerprints ``a`` of
    larger nodes with the mask that they are ``held`` under, with no ``b``. A task keeps a batch and ``most`` more."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = masks = none = np.zeros(0, np.uint64)  # the node that the last batch ended in
        passed = None  # the large node that was handed back last: more of it may come
        for batch in batches:
            fps, under = (batch[name].to_numpy().view(np.uint64) for name in ("fp", "mask"))
            if passed:
                more = (under == passed[0]) & (fps & under == passed[1])
                yield _rows(a=fps[more], held=under[more])
                fps, under = fps[~more], under[~more]
            codes, masks = np.concatenate([codes, fps]), np.concatenate([masks, under])
            ends = np.flatnonzero(_begins(codes, masks))[-1:].sum()
            yield from _node_rows(codes[:ends], masks[:ends], most)
            codes, masks = codes[ends:], masks[ends:]
            if len(codes) > most:
                yield _rows(a=codes, held=masks)
                passed = masks[0], codes[0] & masks[0]
                codes = masks = none
        yield from _node_rows(codes, masks, most)

    return in_arrow(ordered, work, "a long, b long, held long")


def _begins(codes: np.ndarray, masks: np.ndarray) -> np.ndarray:
    """Whether a node begins at each place of a sorted run."""
    new = np.ones(len(codes), bool)
    new[1:] = (masks[1:] != masks[:-1]) | ((codes[1:] ^ codes[:-1]) & masks[1:] != 0)
    return new


def _node_rows(codes: np.ndarray, masks: np.ndarray, most: int) -> Iterator[pa.RecordBatch]:
    starts = np.flatnonzero(_begins(codes, masks))
    size = np.diff(np.append(starts, len(codes)))
    two = starts[size == 2]
    near = two[np.bitwise_count(codes[two] ^ codes[two + 1]) <= 2]
    small = np.flatnonzero((size > 2) & (size <= most))
    found = [(codes[near], codes[near + 1]), *[node_links(codes[starts[i] : starts[i] + size[i]]) for i in small]]
    a, b = (np.concatenate(x).view(np.int64) for x in zip(*found))  # noqa: B905
    yield _rows(a=np.minimum(a, b), b=np.maximum(a, b))
    large = np.repeat(size > most, size)
    yield _rows(a=codes[large], held=masks[large])


def _rows(**columns: np.ndarray) -> pa.RecordBatch:
    given = {name: pa.array(x.view(np.int64)) for name, x in columns.items()}
    none = pa.nulls(len(columns["a"]), pa.int64())
    return pa.RecordBatch.from_arrays([given.get(name, none) for name in ("a", "b", "held")], ["a", "b", "held"])


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fingerprint, component_id) of every row: its SimHash in hex, and the smallest doc_id among all that
    it reaches by links of two bits or fewer, itself included. Empty and null texts have fingerprint zero and are
    linked like others. Rows with a null doc_id get the component of their fingerprint; a fingerprint that only such
    rows have takes no part in linking, and its component is null. Repeated rows and ties share a fingerprint."""
    fps = written(fingerprints(docs, id_col, text_col), "fingerprints")
    nodes = written(fps.groupBy("fp").agg(F.min("doc_id").alias("node")), "fingerprint-nodes")
    known = nodes.where("node is not null")
    # a node is named by its smallest doc_id, which makes component names the smallest doc_id reached
    pairs = links(known)
    edges = pairs.join(known.select(F.col("fp").alias("a"), F.col("node").alias("x")), "a").join(known.select(F.col("fp").alias("b"), F.col("node").alias("y")), "b")
    groups = connected_components(edges.select(F.col("x").alias("a"), F.col("y").alias("b")))
    labelled = nodes.join(groups, "node", "left").select("fp", F.coalesce("component", "node").alias("component_id"))
    return fps.join(labelled, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def one_of_each(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each group of near duplicates: that of the smallest doc_id, rows without one last, and
    of rows with the same id one only. Rows without a doc_id are linked like others here."""
    whole, row = numbered(docs)
    rows = renamed(whole, doc_id="doc_id", text="text", **{ROW: row})
    fps = fingerprints(rows, ROW).select(F.col("doc_id").alias(ROW), "fp")
    nodes = written(nodes_of(fps.join(rows.select(ROW, "doc_id"), ROW).withColumnRenamed("fp", "key")), "fingerprint-nodes")
    ends = nodes.select("key", "node")
    pairs = links(nodes.select(F.col("key").alias("fp")))
    edges = pairs.join(ends.toDF("a", "x"), "a").join(ends.toDF("b", "y"), "b").select(F.col("x").alias("a"), F.col("y").alias("b"))
    return first_of_each(whole, row, nodes, edges)
