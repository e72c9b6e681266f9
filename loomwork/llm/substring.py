"""Substring dedup by seed and extend on winnowed anchors.

A word of a document is removed if it lies in a window of ``length`` words whose sequence also starts in a document
with a smaller doc_id. Every window holds one anchor: the word gram of smallest hash among its grams (the rightmost
on a tie), so equal windows have equal anchors at equal places, and about one word in thirteen starts an anchor.
The windows that share an anchor occurrence are one run of starts; what they cover together is its reach.

1. Seed: occurrences are joined on the anchor's hash. An anchor that one document alone has takes no further part.
2. Extend, whole reach: occurrences whose anchor and whole reach are equal are one class; all but those of the
   smallest document repeat it from end to end. Copies of any number fall into one class here and are never paired.
3. Extend, word by word: where an anchor has several classes, one representative each goes on. Its windows are
   compared, at the same distance from the anchor, with those of the other representatives, by a digest of the
   window: the matching windows on both sides of the anchor make up the maximal repeat.

Rows grow with the text, not with the square of a group: no step pairs the members of a group. Hashes are 64 bits
of the words; a match needs anchor and window hashes to agree together.

Words are ``[^\\x20\\x09-\\x0D]+``. A null text has none, and nothing is removed from texts of fewer than ``length``
words. A null doc_id is neither smaller nor larger than another: such rows are returned whole and remove nothing.
Rows with the same doc_id remove nothing from each other, and each loses what its own text repeats of smaller ids: ranges
are kept by id and text (as a 64-bit hash), so repeated rows come out alike and other texts of that id are not touched.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomwork.llm._common import in_arrow, inside, mapped, outside, renamed, text_bytes, written

LENGTH = 50
BASE = 0x9E3779B97F4A7C15  # odd, so that it has an inverse modulo 2**64
INVERSE = pow(BASE, -1, 1 << 64)
MEMO = 1_000_000


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= MEMO:
            self.clear()
        h = self[word] = xxhash.xxh64_intdigest(word, 9)
        return h


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base & (1 << 64) - 1, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(29))


class _Rolling:
    """Hashes of any word range of one text."""

    def __init__(self, words: list[bytes], hashes: _WordHashes):
        n = len(words)
        each = np.fromiter((hashes[w] for w in words), np.uint64, n)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(each * _powers(BASE, n), out=self.sums[1:])
        self.back = _powers(INVERSE, n + 1)

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return _mixed((self.sums[end] - self.sums[start]) * self.back[start])


def _anchors(grams: np.ndarray, count: int) -> np.ndarray:
    """For each run of ``count`` grams, where the smallest is (the rightmost of equals)."""
    at, h, size = np.arange(len(grams)), grams, 1
    while size < count:
        step = min(size, count - size)
        right, h_right = at[step:], h[step:]
        take = h_right <= h[:-step]
        at, h = np.where(take, right, at[:-step]), np.where(take, h_right, h[:-step])
        size += step
    return at


def seeds(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """(doc_id, version, anchor, reach, at, before, more): a document's anchors with the hash of their reach; ``at`` lists
    where the anchor starts with this reach, the first window that it stands for starts ``before`` words earlier,
    and ``more`` windows follow that one."""
    kind, gram = docs.schema["doc_id"].dataType.simpleString(), length // 2
    count = length - gram + 1

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = _WordHashes()
        for batch in batches:
            rows: list[tuple[np.ndarray, ...]] = []
            key: list[int] = []
            ends = [np.zeros(1, np.int64)]
            for i, text in enumerate(text_bytes(batch["text"])):
                words = text.split()
                if len(words) < length:
                    continue
                rolling = _Rolling(words, hashes)
                starts = np.arange(len(words) - gram + 1)
                grams = rolling.of(starts, starts + gram)
                at = _anchors(grams, count)
                first = np.flatnonzero(np.concatenate(([True], at[1:] != at[:-1])))
                last = np.concatenate((first[1:], [len(at)])) - 1
                at = at[first]
                reach = rolling.of(first, last + length) ^ _mixed(((at - first) << 16 | (last - first)).astype(np.uint64))
                order = np.lexsort((at, reach, grams[at]))
                anchor, reach, at, first, last = (x[order] for x in (grams[at], reach, at, first, last))
                new = np.flatnonzero(np.concatenate(([True], (anchor[1:] != anchor[:-1]) | (reach[1:] != reach[:-1]))))
                rows.append((anchor[new].view(np.int64), reach[new].view(np.int64), (at - first)[new], (last - first)[new], at))
                ends.append(np.append(new[1:], len(at)) + ends[-1][-1])
                key += [i] * len(new)
            if rows:
                anchor, reach, before, more, at = [pa.array(np.concatenate(c)) for c in zip(*rows, strict=True)]
                places = pa.ListArray.from_arrays(pa.array(np.concatenate(ends), pa.int32()), at.cast(pa.int32()))
                ids, versions = (batch[c].take(pa.array(key, pa.int64())) for c in ("doc_id", "version"))
                yield pa.RecordBatch.from_arrays([ids, versions, anchor, reach, places, before.cast(pa.int32()), more.cast(pa.int32())], ["doc_id", "version", "anchor", "reach", "at", "before", "more"])

    return in_arrow(docs, work, f"doc_id {kind}, version long, anchor long, reach long, at array<int>, before int, more int")


def _windows(docs: DataFrame, places: DataFrame, length: int) -> DataFrame:
    """(doc_id, version, anchor, off, digest, start) of the windows of the chosen anchor occurrences."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = _WordHashes()
        for batch in batches:
            for text, place, i in zip(text_bytes(batch["text"]), batch["places"], range(batch.num_rows), strict=True):
                words = text.split()
                anchor, at, before, more = (place.values.field(c).to_numpy().astype(np.int64) for c in ("anchor", "at", "before", "more"))
                lo, n = at - before, more + 1
                start = np.repeat(lo, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                digest = _Rolling(words, hashes).of(start, start + length).view(np.int64)
                ids, versions = (batch[c].take(pa.array(np.full(len(start), i))) for c in ("doc_id", "version"))
                yield pa.RecordBatch.from_arrays([ids, versions, pa.array(np.repeat(anchor, n)), pa.array(start - np.repeat(at, n), pa.int32()), pa.array(digest), pa.array(start, pa.int32())], ["doc_id", "version", "anchor", "off", "digest", "start"])

    # most texts need not be dealt out
    needed = inside(docs, mapped(places, _key()), _key())
    chosen = needed.join(places, TEXT).select(*TEXT, "text", "places")
    return in_arrow(chosen, work, f"doc_id {kind}, version long, anchor long, off int, digest long, start int")


#: What a row's ranges are kept by.
TEXT = ["doc_id", "version"]


def _versioned(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", F.xxhash64("text").alias("version"), "text")


def _key() -> Column:
    return F.xxhash64(*TEXT)


def repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """(doc_id, version, start, end): word ranges of (doc_id, version, text) that repeat a smaller document's, overlaps
    included."""
    docs = docs.where("doc_id is not null")
    found = written(seeds(docs, length), "seeds")
    first = F.min(F.struct(*TEXT, "at", "before", "more")).alias("first")
    classes = found.groupBy("anchor", "reach").agg(first, F.count("*").alias("n"))
    classes = written(classes.select("anchor", "reach", F.col("first.doc_id").alias("owner"), F.col("first.version").alias("version"), "first.at", "first.before", "first.more", "n"), "reach-classes")

    shared = classes.where("n > 1").select("anchor", "reach", "owner", F.col("version").alias("owner_version"))
    screened = inside(found, mapped(shared, F.col("reach")), F.col("reach"))
    members = screened.join(shared, ["anchor", "reach"])
    later = members.where("doc_id > owner").select(*TEXT, F.explode("at").alias("at"), "before", "more")
    start = F.col("at") - F.col("before")
    whole = later.select(*TEXT, start.alias("start"), (start + F.col("more") + length).alias("end"))

    several = classes.groupBy("anchor").agg(F.min("owner").alias("x"), F.max("owner").alias("y")).where("x < y").select("anchor")
    named = classes.select(F.col("owner").alias("doc_id"), "version", "anchor", "at", "before", "more")
    if _ids_repeat(found):
        # other texts of the owner's id are in its class, but lose only what they repeat of smaller ids
        named = named.unionByName(members.where("doc_id = owner and version <> owner_version").select(*TEXT, "anchor", "at", "before", "more").distinct())
    chosen = named.join(several, "anchor").select(*TEXT, "anchor", F.explode("at").alias("at"), "before", "more")
    places = written(chosen.groupBy(*TEXT).agg(F.collect_list(F.struct("anchor", "at", "before", "more")).alias("places")), "places")
    windows = written(_windows(docs, places, length), "windows")
    least = windows.groupBy("anchor", "off", "digest").agg(F.min("doc_id").alias("owner"), F.max("doc_id").alias("latest")).where("owner < latest").drop("latest")
    part = windows.join(least, ["anchor", "off", "digest"]).where("doc_id > owner").select(*TEXT, "start", (F.col("start") + length).alias("end"))
    return whole.unionByName(part)


def maximal_repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """(doc_id, version, start, end): the runs of words of (doc_id, text) that repeat smaller documents, as far as they go
    both ways: ranges that overlap or touch are one. A document's ranges are put together by themselves."""
    ranges = repeats(_versioned(docs), length).distinct()
    before = Window.partitionBy(*TEXT).orderBy("start", "end").rowsBetween(Window.unboundedPreceding, -1)
    begins = (F.col("start") > F.coalesce(F.max("end").over(before), F.lit(-1))).cast("int")
    run = F.sum("begins").over(Window.partitionBy(*TEXT).orderBy("start", "end").rowsBetween(Window.unboundedPreceding, 0))
    return ranges.withColumn("begins", begins).withColumn("run", run).groupBy(*TEXT, "run").agg(F.min("start").alias("start"), F.max("end").alias("end")).drop("run")


def _ids_repeat(found: DataFrame) -> bool:
    """Whether some id has several texts."""
    versions = found.groupBy("doc_id").agg(F.min("version").alias("x"), F.max("version").alias("y"))
    return not versions.where("x <> y").isEmpty()


def without_repeats(docs: DataFrame, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256, kept) of every row: the words left, joined by one space, and their
    digest. The ranges of a document are gathered for it alone, at most one for each of its words."""
    docs = renamed(docs, doc_id=id_col, text=text_col)
    return _cut(docs, length, True)


def digests(docs: DataFrame, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``without_repeats`` without the words themselves."""
    return _cut(renamed(docs, doc_id=id_col, text=text_col), length, False)


def _cut(docs: DataFrame, length: int, texts: bool) -> DataFrame:
    kind = docs.schema["doc_id"].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, gone, sha, left = [], [], [], []
            for text, spans in zip(text_bytes(batch["text"]), batch["spans"], strict=True):
                words = text.split()
                n.append(len(words))
                if spans.is_valid:
                    edges = np.zeros(len(words) + 1, np.int64)
                    start, end = (np.minimum(spans.values.field(c).to_numpy(), len(words)) for c in ("start", "end"))
                    np.add.at(edges, start, 1)
                    np.add.at(edges, end, -1)
                    keep = np.cumsum(edges[:-1]) == 0
                    words = [words[i] for i in np.flatnonzero(keep).tolist()]
                gone.append(n[-1] - len(words))
                kept = b" ".join(words)
                sha.append(hashlib.sha256(kept).hexdigest())
                left.append(kept if texts else None)
            cols = [pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(sha, pa.string())]
            names = ["doc_id", "n_words", "n_removed", "kept_sha256"]
            if texts:
                cols.append(pa.array(left, pa.binary()).cast(pa.string()))
                names.append("kept")
            yield pa.RecordBatch.from_arrays([batch["doc_id"], *cols], names)

    docs = _versioned(docs)
    spans = written(repeats(docs, length).distinct().groupBy(*TEXT).agg(F.collect_list(F.struct("start", "end")).alias("spans")), "spans")
    schema = f"doc_id {kind}, n_words long, n_removed long, kept_sha256 string" + ", kept string" * texts
    touched = mapped(spans, _key())
    with_spans = inside(docs, touched, _key()).join(spans, TEXT, "left").select("doc_id", "text", "spans")
    without = outside(docs, touched, _key()).select("doc_id", "text", F.lit(None).cast(spans.schema["spans"].dataType).alias("spans"))
    return in_arrow(with_spans, work, schema).unionByName(in_arrow(without, work, schema))
