"""Token-id files: a concatenated id array whose document boundaries are Elias-Fano encoded.

Documents are dealt to tasks by ranges of doc_id and encoded in ascending order. Each task cuts its run into
segments, and a segment is one binary image: a header, the boundaries, their select directory, and the ids in the
narrowest unsigned type that holds the vocabulary. The boundaries take about ``2 + log2(ids / documents)`` bits
each; ``select`` finds any of them through the directory, so no table of 64-bit offsets is stored. Spark's writer
commits the images as rows of a Parquet table, which works on any store and survives lost executors.

Nulls: a null text is empty and holds the end id alone; rows with a null doc_id come first. Rows with the same
doc_id stand in the order of their texts, a null one first. An empty input gives a table without segments.
"""

from __future__ import annotations

import os
import re
import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loomwork.llm import bpe
from loomwork.llm._common import in_arrow, renamed, written

#: A segment is closed at so many ids or documents; a longer document makes a longer segment of its own.
SEGMENT_IDS = 1 << 16
SEGMENT_DOCS = 1 << 12
#: Bits between the entries of the select directory.
STRIDE = 512
HEAD = struct.Struct("<4sBBHQQQ")  # magic, bytes an id, low bits, unused, boundaries, ids, bytes of the high bits
MAGIC = b"TIDS"
#: Pieces of a generation that a worker remembers.
MEMO = 400_000
#: Bytes of text that are cut into pieces together.
STEP_BYTES = 8 << 20


#: Kinds of bytes: white space; what a letter ends with; ASCII punctuation or a digit, the apostrophe excepted; and,
#: after 0xC3, the last byte of an accented letter. They are those of ``bpe.pieces``.
BLANK, LETTER, MARK = 1, 2, 4
KINDS = np.array([BLANK if bytes([b]).isspace() else LETTER if 0x61 <= b <= 0x7A else MARK if re.match(rb"[!-&(-@\[-`{-~]", bytes([b])) else 0 for b in range(256)], np.uint8)
LATER = np.array([LETTER if 0x80 <= b <= 0xBF and b not in (0x97, 0xB7) else 0 for b in range(256)], np.uint8)
LOWER = np.frombuffer(bytes(range(256)).lower(), np.uint8)


class EliasFano:
    """A non-decreasing sequence in ``low`` plain bits and one unary bit vector, with a select directory."""

    def __init__(self, n: int, low_bits: int, low: np.ndarray, high: np.ndarray, directory: np.ndarray):
        self.n, self.low_bits, self.low, self.high, self.directory = n, low_bits, low, high, directory

    @classmethod
    def of(cls, values: np.ndarray) -> EliasFano:
        values = np.asarray(values, np.uint64)
        n, top = len(values), int(values[-1]) if len(values) else 0
        low_bits = max(0, (top // n).bit_length() - 1) if n else 0
        each = (values[:, None] >> np.arange(low_bits, dtype=np.uint64)) & np.uint64(1)
        low = np.packbits(each.astype(np.uint8).ravel(), bitorder="little")
        size = -(-(n + (top >> low_bits) + 1) // STRIDE) * STRIDE
        bits = np.zeros(size, np.uint8)
        bits[(values >> np.uint64(low_bits)).astype(np.int64) + np.arange(n)] = 1
        directory = np.cumsum(bits.reshape(-1, STRIDE).sum(1, dtype=np.uint32), dtype=np.uint32)
        return cls(n, low_bits, low, np.packbits(bits, bitorder="little"), directory)

    def select(self, i: int) -> int:
        """The i-th value."""
        block = int(np.searchsorted(self.directory, i, side="right"))
        before = int(self.directory[block - 1]) if block else 0
        bits = np.unpackbits(self.high[block * STRIDE // 8 : (block + 1) * STRIDE // 8], bitorder="little")
        at = block * STRIDE + int(np.flatnonzero(bits)[i - before])
        first = i * self.low_bits
        part = np.unpackbits(self.low[first // 8 : (first + self.low_bits + 7) // 8], bitorder="little")
        rest = part[first % 8 : first % 8 + self.low_bits]
        return (at - i) << self.low_bits | int(rest @ (1 << np.arange(self.low_bits, dtype=np.int64)))

    def values(self) -> np.ndarray:
        """All values at once."""
        at = np.flatnonzero(np.unpackbits(self.high, bitorder="little"))[: self.n] - np.arange(self.n)
        bits = np.unpackbits(self.low, bitorder="little")[: self.n * self.low_bits].reshape(self.n, self.low_bits)
        return (at << self.low_bits) + bits @ (1 << np.arange(self.low_bits, dtype=np.int64))


def image(lengths: list[int], ids: np.ndarray, width: int) -> bytes:
    """The file image of a run of documents: their lengths in ids, and all ids."""
    ends = EliasFano.of(np.cumsum(lengths))
    head = HEAD.pack(MAGIC, width, ends.low_bits, 0, ends.n, len(ids), len(ends.high))
    return b"".join((head, ends.high.tobytes(), ends.directory.astype("<u4").tobytes(), ends.low.tobytes(), ids.astype(f"<u{width}").tobytes()))


def opened(blob: bytes) -> tuple[EliasFano, np.ndarray]:
    """Boundaries (the end of each document) and ids of an image."""
    magic, width, low_bits, _, n, size, high = HEAD.unpack_from(blob)
    if magic != MAGIC:
        raise ValueError("not a token-id image")
    at = HEAD.size
    cut = [at, at := at + high, at := at + high * 8 // STRIDE * 4, at := at + -(-n * low_bits // 8)]
    data = np.frombuffer(blob, np.uint8)
    ends = EliasFano(n, low_bits, data[cut[2] : cut[3]], data[cut[0] : cut[1]], np.frombuffer(blob, "<u4", high * 8 // STRIDE, cut[1]))
    return ends, np.frombuffer(blob, f"<u{width}", size, at)


def cut_pieces(texts: pa.Array) -> tuple[pa.DictionaryArray, np.ndarray]:
    """The pieces of ``bpe.pieces`` of all texts, as one dictionary array, and the number of each text's. The bytes are
    classed in numpy, so that only distinct pieces cost Python anything."""
    texts = texts.cast(pa.large_binary()).fill_null(b"")
    ends = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[ends[0] : ends[-1]]
    ends = ends[1:] - ends[0]
    kept = LOWER[data]
    after = np.zeros(len(data) + 1, np.uint8)  # the class of what stands before each place
    after[1:] = KINDS[kept]
    accented = np.flatnonzero(kept[:-1] == 0xC3) + 1
    after[accented + 1] |= LATER[kept[accented]]
    starts_new = np.zeros(len(data) + 1, bool)
    starts_new[:-1] = ((after[:-1] & LETTER) > 0) & ((KINDS[kept] & MARK) > 0)
    starts_new[np.concatenate((np.zeros(1, np.int64), ends))] = True
    solid = (after[1:] & BLANK) == 0
    starts_new[1:-1] |= ~solid[:-1]
    first = np.flatnonzero(starts_new[:-1] & solid)
    offsets = np.append(np.concatenate((np.zeros(1, np.int64), np.cumsum(solid)))[first], solid.sum()) if len(first) else np.zeros(1, np.int64)
    pieces = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(first), [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(kept[solid])])
    return pieces.dictionary_encode(), np.diff(np.searchsorted(first, ends, side="left"), prepend=0)


class _Encoder:
    """The library with the ids of the pieces it has encoded, in two generations, so that memory is bounded."""

    def __init__(self, tokenizer: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark deals out the work
        from tokenizers import Tokenizer

        bpe.read_spec(tokenizer)  # raises for a file whose texts can't be cut so
        self.library = Tokenizer.from_file(tokenizer)
        self.library.no_truncation()
        self.library.no_padding()
        self.new: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}

    def learned(self, pieces: list[bytes], width: int) -> dict[bytes, bytes]:
        """The ids of all the distinct pieces; each new one goes to the library once."""
        if len(self.new) > MEMO:
            self.old, self.new = self.new, {}
        new, old, unknown = self.new, self.old, []
        for piece in pieces:
            if piece not in new:
                if piece in old:
                    new[piece] = old[piece]
                else:
                    unknown.append(piece)
        found = self.library.encode_batch_fast([p.decode("utf-8", "replace") for p in unknown], add_special_tokens=False)
        for piece, e in zip(unknown, found, strict=True):
            new[piece] = struct.pack(f"<{len(e)}{'H' if width == 2 else 'I'}", *e.ids)
        return new

    def encoded(self, texts: pa.Array, width: int) -> list[bytes]:
        """The ids of each text."""
        raw = texts.cast(pa.large_binary()).fill_null(b"")
        odd = [i for i, t in enumerate(raw) if bpe.whole_words(t.as_py())]
        plain = raw if not odd else pc.if_else(pa.array(np.isin(np.arange(len(raw)), odd)), pa.scalar(b"", pa.large_binary()), raw)
        pieces, count = cut_pieces(plain)
        words = pieces.dictionary.to_pylist()
        memo = self.learned(words, width)
        each = [memo[w] for w in words]
        size = np.fromiter(map(len, each), np.int64, len(each)) // width
        ids, at = np.frombuffer(b"".join(each), f"<u{width}"), np.cumsum(size) - size
        index = pieces.indices.to_numpy()
        till = np.cumsum(size[index])
        spread = np.repeat(at[index] - (till - size[index]), size[index]) + np.arange(till[-1] if len(till) else 0)
        cuts = np.concatenate((np.zeros(1, np.int64), till))[np.cumsum(count)]
        out = [part.tobytes() for part in np.split(ids[spread], cuts)[: len(raw)]]
        for i in odd:
            split = raw[i].as_py().split()
            memo = self.learned(list(dict.fromkeys(split)), width)
            out[i] = b"".join([memo[p] for p in split])
        return out


@lru_cache(maxsize=4)
def _encoder(tokenizer: str, end_id: int) -> _Encoder:
    """One per Python worker and file, kept from task to task."""
    return _Encoder(tokenizer)


def _steps(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """(first, number) of runs of texts of about STEP_BYTES."""
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    at = held = 0
    for i, size in enumerate(sizes.tolist()):
        held += size
        if held >= STEP_BYTES or i == len(sizes) - 1:
            yield at, i + 1 - at
            at, held = i + 1, 0


def write(docs: DataFrame, tokenizer: str, end_id: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Write the token-id table of ``docs`` to the shared folder and return it as read back: ``part``, ``segment``,
    ``start`` (ids of the part before the segment), ``n_ids``, ``doc_ids`` and ``image``."""
    kind = docs.schema[id_col].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(tokenizer, end_id)
        width = 2 if max(encoder.library.get_vocab_size(), end_id + 1) <= 1 << 16 else 4
        end = np.array([end_id], f"<u{width}").tobytes()
        part, segment, start = TaskContext.get().partitionId(), 0, 0
        keys: list = []
        lengths: list[int] = []
        parts: list[bytes] = []
        held = 0

        def closed() -> pa.RecordBatch:
            ids = np.frombuffer(b"".join(parts), f"<u{width}")
            return pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([segment], pa.int32()), pa.array([start], pa.int64()), pa.array([held], pa.int64()), pa.array([keys], pa.list_(keyed)), pa.array([image(lengths, ids, width)], pa.binary())],
                ["part", "segment", "start", "n_ids", "doc_ids", "image"],
            )

        for batch in batches:
            keyed = batch["doc_id"].type
            for at, n in _steps(batch["text"]):
                for key, ids in zip(batch["doc_id"].slice(at, n).to_pylist(), encoder.encoded(batch["text"].slice(at, n), width), strict=True):
                    ids += end
                    if keys and (held + len(ids) // width > SEGMENT_IDS or len(keys) >= SEGMENT_DOCS):
                        yield closed()
                        segment, start = segment + 1, start + held
                        keys, lengths, parts, held = [], [], [], 0
                    keys.append(key)
                    lengths.append(len(ids) // width)
                    parts.append(ids)
                    held += len(ids) // width
        if keys:
            yield closed()

    dealt = renamed(docs, doc_id=id_col, text=text_col).repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    schema = f"part int, segment int, start long, n_ids long, doc_ids array<{kind}>, image binary"
    return written(in_arrow(dealt, work, schema), "token-ids")


def read(segments: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids) of each document of a token-id table; ``start`` counts the ids before it."""
    kind = segments.schema["doc_ids"].dataType.elementType.simpleString()
    return _documents(segments, f"doc_id {kind}, part int, at long, n_tokens long, ids array<long>", lambda ids: ids.tolist(), pa.list_(pa.int64()))


def read_digests(segments: DataFrame) -> DataFrame:
    """As ``read``, with ``ids_crc32`` (of the ids as little-endian unsigned 32-bit integers) in place of the ids."""
    kind = segments.schema["doc_ids"].dataType.elementType.simpleString()
    return _documents(segments, f"doc_id {kind}, part int, at long, n_tokens long, ids_crc32 long", lambda ids: zlib.crc32(ids.astype("<u4").tobytes()), pa.int64())


def document(segment: bytes, position: int) -> np.ndarray:
    """The ids of the document at ``position`` of a segment image, found without its other boundaries."""
    ends, ids = opened(segment)
    if not 0 <= position < ends.n:
        raise IndexError(position)
    return ids[ends.select(position - 1) if position else 0 : ends.select(position)]


def _documents(segments: DataFrame, schema: str, derive, derived: pa.DataType) -> DataFrame:
    last = schema.rsplit(", ", 1)[1].split(" ")[0]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, start, keys, blob in zip(batch["part"], batch["start"].to_pylist(), batch["doc_ids"], batch["image"], strict=True):
                ends, ids = opened(blob.as_py())
                till = np.fromiter(map(ends.select, range(ends.n)), np.int64, ends.n)
                first = np.concatenate(([0], till[:-1]))
                out = [derive(ids[a:b]) for a, b in zip(first.tolist(), till.tolist(), strict=True)]
                n = len(out)
                yield pa.RecordBatch.from_arrays(
                    [keys.values, pa.array([part.as_py()] * n, pa.int32()), pa.array(first + start, pa.int64()), pa.array(till - first, pa.int64()), pa.array(out, derived)],
                    ["doc_id", "part", "at", "n_tokens", last],
                )

    # one row for each part: as many as the writer had tasks
    parts = segments.groupBy("part").agg(F.sum("n_ids").alias("n_ids"))
    before = F.coalesce(F.sum("n_ids").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = parts.select("part", before.alias("before"))
    each = in_arrow(segments.select("part", "start", "doc_ids", "image"), work, schema)
    return each.join(F.broadcast(offsets), "part").select("doc_id", (F.col("before") + F.col("at")).alias("start"), "n_tokens", last)
