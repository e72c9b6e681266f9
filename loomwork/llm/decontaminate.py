"""Benchmark decontamination by a hash set of the benchmark's word n-grams.

The benchmark's windows (``width`` consecutive words of an item, or a shorter item's whole) are counted first. Up to
``broadcast_windows`` of them become a hash set that every task gets; beyond that, windows of both sides are dealt
out by their digest and joined, so the plan doesn't depend on the benchmark being small. Either way all windows of
all documents are looked at, and a window counts only if it equals an item's word for word.

Words are runs of the bytes ``0-9 a-z 0x80-0xFF`` after lower-casing A-Z. A null text has no words. Items without
words, and items with a null text or id, are left out. Repeated items and documents count each for itself.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomwork.llm._common import WORD_TABLE, bounded_batches, in_arrow, renamed, text_bytes
from loomwork.llm.components import numbered

WIDTH = 13
#: Windows that are broadcast at most: about 100 bytes each.
BROADCAST_WINDOWS = 500_000
#: Slots for each window in the table that most others are turned away by.
FILTER_SLOTS = 32
MIX = np.uint64(0x9E3779B97F4A7C15)


def words_of(text: bytes) -> list[bytes]:
    return text.translate(WORD_TABLE).split()


def item_windows(items: DataFrame, width: int = WIDTH) -> DataFrame:
    """(item, window): the distinct windows of each item as arrays of words, by DataFrame functions."""
    lower = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    words = F.filter(F.split(F.regexp_replace(lower, r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", " "), " "), lambda w: w != "")
    starts = F.sequence(F.lit(1), F.greatest(F.size("words") - (width - 1), F.lit(1)))
    spelled = items.where("text is not null and item_id is not null").select(F.col("item_id").cast("string").alias("item"), words.alias("words"))
    return spelled.where("size(words) > 0").select("item", F.explode(F.transform(starts, lambda i: F.slice("words", i, width))).alias("window")).distinct()


class WindowSet:
    """The benchmark's windows, by length: ids of the benchmark's words, a bit table of rolling hashes, and the
    windows themselves, which every hit is verified by."""

    def __init__(self, windows: list[tuple[tuple[bytes, ...], list[str]]]):
        self.word: dict[bytes, int] = {}
        by_length: dict[int, dict[tuple[int, ...], list[str]]] = {}
        for words, items in windows:
            ids = tuple(self.word.setdefault(w, len(self.word) + 1) for w in words)
            by_length.setdefault(len(ids), {})[ids] = items
        self.by_length: dict[int, tuple[np.ndarray, dict[tuple[int, ...], list[str]]]] = {}
        for length, known in by_length.items():
            bits = (FILTER_SLOTS * len(known)).bit_length()
            filter_ = np.zeros(1 << bits, bool)
            ids = np.array(list(known), np.uint64).ravel()
            filter_[self._slots(ids, np.arange(0, len(ids), length), length, bits)] = True
            self.by_length[length] = filter_, known

    @staticmethod
    def _slots(ids: np.ndarray, at: np.ndarray, length: int, bits: int) -> np.ndarray:
        """Slots of the windows that start at the given places."""
        h = np.zeros(len(at), np.uint64)
        for k in range(length):
            h = h * MIX + ids[at + k]
        h ^= h >> np.uint64(29)
        return (h * MIX) >> np.uint64(64 - bits)

    def hits(self, words: list[bytes]) -> tuple[np.ndarray, set[str]]:
        """Which words a window covers, and the items whose windows occur."""
        hit, items = np.zeros(len(words), bool), set()
        get = self.word.get
        ids = np.fromiter((get(w, 0) for w in words), np.uint64, len(words))
        strange = np.concatenate(([0], np.cumsum(ids == 0)))  # words that no window has
        for length, (filter_, known) in self.by_length.items():
            if len(ids) < length:
                continue
            at = np.flatnonzero(strange[length:] == strange[:-length])
            if len(at):
                bits = len(filter_).bit_length() - 1
                for i in at[filter_[self._slots(ids, at, length, bits)]].tolist():
                    found = known.get(tuple(ids[i : i + length].tolist()))
                    if found:
                        hit[i : i + length] = True
                        items.update(found)
        return hit, items


def hits(docs: DataFrame, items: DataFrame, width: int = WIDTH, broadcast_windows: int = BROADCAST_WINDOWS) -> DataFrame:
    """(doc_id, text, n_words, n_hit, n_items, items_sha256, spans) of every row: ``spans`` are the (start, end) word
    ranges that windows of ``items`` cover; the digest is of the sorted, comma-joined ids of the items found."""
    windows = item_windows(items, width)
    if _small(windows, broadcast_windows):
        return _scanned(docs, windows)
    return _joined(docs, windows, width)


def _small(windows: DataFrame, broadcast_windows: int) -> bool:
    """The bound on what is broadcast: a number of windows, and 200 characters of text for each."""
    n, text = windows.agg(F.count("*"), F.sum(F.length(F.array_join("window", " ")))).first()
    return n <= broadcast_windows and (text or 0) <= 200 * broadcast_windows


SCHEMA = "doc_id {kind}, text string, n_words long, n_hit long, n_items long, items_sha256 string, spans array<struct<start:long,end:long>>"


def spans_of(hit: np.ndarray) -> list[dict[str, int]]:
    edges = np.flatnonzero(np.diff(np.concatenate(([0], hit.view(np.int8), [0]))))
    return [{"start": a, "end": b} for a, b in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True)]


def _row(text: bytes, n: int, hit: np.ndarray, items: set[str]) -> dict:
    digest = hashlib.sha256(",".join(sorted(items)).encode()).hexdigest()
    return {"text": text, "n_words": n, "n_hit": int(hit.sum()), "n_items": len(items), "items_sha256": digest, "spans": spans_of(hit)}


def _batch(doc_ids: pa.Array, texts: pa.Array, rows: list[dict]) -> pa.RecordBatch:
    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    kinds = {"n_words": pa.int64(), "n_hit": pa.int64(), "n_items": pa.int64(), "items_sha256": pa.string(), "spans": span}
    cols = [pa.array([r[c] for r in rows], kind) for c, kind in kinds.items()]
    return pa.RecordBatch.from_arrays([doc_ids, texts, *cols], ["doc_id", "text", *kinds])


#: A worker's window set, by the name of what was broadcast, from task to task.
_HELD: dict[str, WindowSet] = {}


def _held(sent: Broadcast) -> WindowSet:
    name, table = sent.value
    if name not in _HELD:
        _HELD.clear()
        _HELD[name] = WindowSet(table)
    return _HELD[name]


def _sent(windows: DataFrame) -> Broadcast:
    table = [(tuple(w.encode() for w in r[0]), sorted(r[1])) for r in windows.groupBy("window").agg(F.collect_set("item")).collect()]
    return windows.sparkSession.sparkContext.broadcast((uuid.uuid4().hex, table))


def _scanned(docs: DataFrame, windows: DataFrame) -> DataFrame:
    kind = docs.schema["doc_id"].dataType.simpleString()
    sent = _sent(windows)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _held(sent)
        for batch in batches:
            rows = []
            for text in text_bytes(batch["text"]):
                words = words_of(text)
                rows.append(_row(text, len(words), *known.hits(words)))
            yield _batch(batch["doc_id"], batch["text"], rows)

    return in_arrow(renamed(docs, doc_id="doc_id", text="text"), work, SCHEMA.format(kind=kind))


def _joined(docs: DataFrame, windows: DataFrame, width: int) -> DataFrame:
    """The same by a join on whole windows, for benchmarks too large to broadcast."""
    keyed, row = numbered(renamed(docs, doc_id="doc_id", text="text"))
    return _joined_by_row(renamed(keyed, row=row, doc_id="doc_id", text="text"), windows).drop("row")


def _joined_by_row(keyed: DataFrame, windows: DataFrame) -> DataFrame:
    """``row`` and the columns of SCHEMA for rows (row, doc_id, text)."""
    kind = keyed.schema["doc_id"].dataType.simpleString()
    lengths = sorted(r[0] for r in windows.select(F.size("window")).distinct().collect())  # at most ``width`` of them

    def shingles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, text in zip(batch["row"].to_pylist(), text_bytes(batch["text"]), strict=True):
                words = words_of(text)
                for length in lengths:
                    for at in range(0, len(words) - length + 1, 4096):
                        till = min(at + 4096, len(words) - length + 1)
                        said = [b" ".join(words[i : i + length]) for i in range(at, till)]
                        yield pa.RecordBatch.from_arrays([pa.array([row] * len(said), pa.int64()), pa.array(range(at, till), pa.int64()), pa.array(said, pa.binary()).cast(pa.string())], ["row", "at", "window"])

    def marked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text, spans, items in zip(text_bytes(batch["text"]), batch["covers"].to_pylist(), batch["items"].to_pylist(), strict=True):
                hit = np.zeros(len(words_of(text)), bool)
                for s in spans or ():
                    hit[s["at"] : s["at"] + s["n"]] = True
                rows.append(_row(text, len(hit), hit, set(items or ())))
            done = _batch(batch["doc_id"], batch["text"], rows)
            yield pa.RecordBatch.from_arrays([batch["row"], *done.columns], ["row", *done.schema.names])

    places = in_arrow(keyed.select("row", "text"), shingles, "row long, at long, window string")
    known = windows.select("item", F.array_join("window", " ").alias("window"), F.size("window").alias("n"))
    found = places.join(known, "window").groupBy("row").agg(F.collect_set(F.struct("at", "n")).alias("covers"), F.collect_set("item").alias("items"))
    return in_arrow(keyed.join(found, "row", "left").select("row", "doc_id", "text", "covers", "items"), marked, "row long, " + SCHEMA.format(kind=kind))


def judged(found: DataFrame, share: int = 20) -> DataFrame:
    """``contaminated``: some word is hit, and hit words are at least one in ``share``."""
    return found.withColumn("contaminated", (F.col("n_hit") > 0) & (F.col("n_hit") * share >= F.col("n_words")))


def without_documents(docs: DataFrame, items: DataFrame, share: int = 20, width: int = WIDTH, broadcast_windows: int = BROADCAST_WINDOWS) -> DataFrame:
    """``docs`` without the contaminated rows; all other rows and columns as they are."""
    windows = item_windows(items, width)
    if not _small(windows, broadcast_windows):
        rows, row = numbered(docs)
        found = _joined_by_row(renamed(rows, row=row, doc_id="doc_id", text="text"), windows)
        bad = judged(found, share).where("contaminated").select(F.col("row").alias(row))
        return rows.join(bad, row, "left_anti").drop(row)
    sent, texts = _sent(windows), docs.columns.index("text")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _held(sent)
        for batch in batches:
            keep = []
            for text in text_bytes(batch.column(texts)):
                words = words_of(text)
                n = int(known.hits(words)[0].sum())
                keep.append(not n or n * share < len(words))
            yield batch.filter(pa.array(keep, pa.bool_()))

    bounded_batches(docs.sparkSession)
    return docs.mapInArrow(work, docs.schema)


def without_spans(docs: DataFrame, items: DataFrame) -> DataFrame:
    """(doc_id, text): texts with the hit words cut out, the words that are left joined by one space where something
    was cut and untouched where nothing was. Null texts stay null."""
    found = hits(docs, items).select("doc_id", "text", "spans")
    kind = docs.schema["doc_id"].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text, spans in zip(batch["text"].to_pylist(), batch["spans"].to_pylist(), strict=True):
                if spans:
                    words = _spelled(text)
                    keep = np.ones(len(words), bool)
                    for s in spans:
                        keep[s["start"] : s["end"]] = False
                    text = " ".join(w for w, k in zip(words, keep, strict=True) if k)
                out.append(text)
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(out, pa.string())], ["doc_id", "text"])

    return in_arrow(found, work, f"doc_id {kind}, text string")


def _spelled(text: str) -> list[str]:
    """The words as the text has them."""
    raw = text.encode()
    same = bytes(b if WORD_TABLE[b] != 0x20 else 0x20 for b in range(256))
    return [w.decode("utf-8", "replace") for w in raw.translate(same).split()]
