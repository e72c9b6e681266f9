"""Alignment of two tokenizers over a corpus: which tokens of one stand where which tokens of the other do.

A byte-level BPE (A) and a SentencePiece BPE (B) encode each text with a space before it. Byte offsets where tokens of
both end cut the text into groups; all token pairs of a group are linked. A pair's count is the number of documents that
hold it linked, over the whole corpus; a link is best if its pair's count is the highest of its A id.

1. Texts are cut before white space that no token of either spans, each distinct piece is encoded once in a worker's
   memory, and a document's links are summed by pair.
2. External spill counting: a task gathers (pair, document) records up to ``RUN``, sorts them by pair, and spills them as
   one zstd run for each radix bucket of the A id. A run has a head, its pairs and how many documents hold each, and a
   body, the documents. Spark commits runs as rows of a table in the shared folder, so a lost executor costs a task.
3. Heads are merged by k-way heap merges, at most ``FAN`` at once, until a bucket has one. Runs are in A-major order, so
   the highest count of an A id is known when its last pair has passed.
4. Each run's body is met with its bucket's counts, and its contributions stream back to its documents.

A frequent token is no hot key: a head has one entry for a pair whatever the number of documents, and bodies are dealt
out by run. Nothing is broadcast or collected but the number of runs.

Null and empty texts, and texts that the two don't spell alike byte for byte (those with U+2581), have no tokens: zeros
and ``''``. Repeated rows and ids are documents of their own. Other columns are ignored. Very long texts are encoded piece
by piece; links of one group are summed by distinct ids of both sides, never token by token.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import os
import re
import unicodedata
from array import array
from collections.abc import Iterable, Iterator
from itertools import chain
from operator import itemgetter

import numpy as np
import pyarrow as pa
import sentencepiece
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from loomwork.llm._common import bounded_batches, in_arrow, renamed, written

#: Blanks in the names of pieces.
BLANK = "\N{LOWER ONE EIGHTH BLOCK}"
#: Texts that are looked at together.
TEXTS = 200
#: Records of a run, radix buckets of A ids (a power of two), and heads or runs that one task takes at once.
RUN = 1 << 21
BUCKETS = 32
FAN = 64
#: Bits of a document's number in a run.
ROW_BITS = 20
#: Entries of a head that are packed together.
HEAD_BLOCK = 1 << 15
#: Pieces and their characters that a worker keeps from batch to batch and task to task, and pieces encoded at once.
PIECES = 400_000
CHARACTERS = 16 << 20
TOGETHER = 500
#: Pairs of one group that are spelled out; larger groups go by distinct ids.
SMALL = 4096


def byte_alphabet() -> dict[str, int]:
    """The characters that byte-level vocabularies write bytes with: printable ones as they are, others from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class Pieces:
    """Both tokenizers, and what they make of the pieces seen so far; each piece has a code."""

    #: White space that a text may be cut before, if the vocabularies allow it.
    CUTS = " \n\t"

    def __init__(self, byte_level: str, pieces: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.a = Tokenizer.from_file(byte_level)
        self.a.no_truncation()
        self.a.no_padding()
        self.a.encode_special_tokens = True
        settings = json.load(open(byte_level, encoding="utf-8"))
        before = settings["pre_tokenizer"] or {}
        if settings["normalizer"] or before.get("type") != "ByteLevel" or before.get("add_prefix_space") or not before.get("use_regex", True):
            raise ValueError(f"{byte_level} isn't a plain byte-level tokenizer")
        alphabet, known = byte_alphabet(), self.a.get_vocab(with_added_tokens=False)
        self.a_bytes = [b""] * (max(known.values()) + 1)
        for token, i in known.items():
            self.a_bytes[i] = bytes(alphabet.get(c, 0x3F) for c in token)
        self.b = sentencepiece.SentencePieceProcessor(model_file=pieces)
        names = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(BLANK, " ").encode() for i, p in enumerate(names)]
        if any("\n" in p and len(p) > 1 for p in names):
            raise ValueError(f"{pieces} has tokens that span line feeds")
        # the library puts a space before each text; behind a line feed, which joins nothing, it doesn't
        self.lead = len(self.b.encode("\n"))
        spanned = {y for p in names for x, y in zip(p, p[1:], strict=False) if x != y}
        cuts = "".join(c for c in self.CUTS if (c if c != " " else BLANK) not in spanned)
        if not cuts:
            raise ValueError(f"{pieces} has tokens that span white space")
        # a cut stands between a character that surely is no white space and one of ``cuts``
        odd = "".join(c for c in map(chr, range(1 << 16)) if c not in cuts and (c.isspace() or unicodedata.category(c) == "Cf"))
        self.cut = re.compile(rf"[{cuts}]*[^{cuts}]+(?:(?<=[{re.escape(odd)}])[{cuts}]+[^{cuts}]*)*|[{cuts}]+").findall
        self.starts, self.no_ends = set(cuts), set(cuts + odd)
        self.a_size, self.b_size = (np.array([len(x) for x in side], np.int64) for side in (self.a_bytes, self.b_bytes))
        #: bits of an A id, of a B id, and of the links of a record
        self.bits = [max(1, (len(side) - 1).bit_length()) for side in (self.a_bytes, self.b_bytes)]
        self.bits.append(64 - sum(self.bits) - ROW_BITS)
        if self.bits[2] < 8:
            raise ValueError("the vocabularies are too large for 64-bit records")
        # ids as text, with what follows them within a group and at its end
        self.text = [np.array([f"{i}{mark}".encode() for mark in marks for i in range(len(side))], object) for side, marks in ((self.a_bytes, ",|"), (self.b_bytes, ",;"))]
        self.forget()

    def forget(self) -> None:
        self.code: dict[str, int] = {}
        self.characters = 0
        self.said: list[bytes] = []
        #: by code: tokens of A, of B, groups, links; -1 for pieces that aren't spelled alike
        self.sizes = np.zeros((0, 4), np.int64)
        #: where a code's pairs end, and the pairs and their links
        self.ends, self.pairs, self.links = np.zeros(1, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def codes(self, texts: list[list[str]]) -> list[np.ndarray]:
        """The codes of the pieces of each text."""
        if len(self.code) > PIECES or self.characters > CHARACTERS:
            self.forget()
        new = [p for p in dict.fromkeys(chain.from_iterable(texts)) if p not in self.code]
        if new:
            self.code.update(zip(new, range(len(self.code), len(self.code) + len(new)), strict=True))
            self.characters += sum(map(len, new))
            self._learn(new)
        get = self.code.__getitem__
        return [np.fromiter(map(get, pieces), np.int64, len(pieces)) for pieces in texts]

    def _encoded(self, texts: list[str]) -> tuple[list[list[int]], list[list[int]]]:
        a = [e.ids for e in self.a.encode_batch_fast(texts, add_special_tokens=False)]
        return a, [ids[self.lead :] for ids in self.b.encode(["\n" + t for t in texts], num_threads=1)]

    def _alike(self, raw: bytes, a: list[int], b: list[int]) -> bool:
        return b"".join([self.a_bytes[i] for i in a]) == raw and b"".join([self.b_bytes[i] for i in b]) == raw

    def _learn(self, new: list[str]) -> None:
        """Encodes ``new``. Pieces with a cut on both sides are encoded many at once, as one text."""
        plain = [p[0] in self.starts and p[-1] not in self.no_ends and BLANK not in p for p in new]
        at = [i for i, x in enumerate(plain) if x]
        together = [at[k : k + TOGETHER] for k in range(0, len(at), TOGETHER)]
        texts = [[new[i] for i in part] for part in together]
        alone = [i for i, x in enumerate(plain) if not x]
        good: list[tuple[list[int], list[str], list[int], list[int]]] = []
        for part, pieces, a, b in zip(together, texts, *self._encoded(["".join(t) for t in texts]), strict=True):
            if self._alike("".join(pieces).encode(), a, b):
                good.append((part, pieces, a, b))
            else:
                alone += part
        for i, a, b in zip(alone, *self._encoded([new[i] for i in alone]), strict=True):
            if self._alike(new[i].encode(), a, b):
                good.append(([i], [new[i]], a, b))
        said, sizes = [b""] * len(new), np.full((len(new), 4), -1, np.int64)
        pairs, links, counts = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(new), np.int64)
        if good:
            which = np.array([i for part, *_ in good for i in part])
            lengths = np.array([len(p.encode()) for _, pieces, *_ in good for p in pieces], np.int64)
            ids = [np.fromiter(chain.from_iterable(g[k] for g in good), np.int64) for k in (2, 3)]
            texts_, sizes[which], (owner, pairs, links) = self._aligned(lengths, *ids)
            for i, text in zip(which.tolist(), texts_, strict=True):
                said[i] = text
            order = np.argsort(which[owner], kind="stable")
            pairs, links = pairs[order], links[order]
            counts = np.bincount(which[owner], minlength=len(new))
        self.said += said
        self.sizes = np.concatenate([self.sizes, sizes])
        self.ends = np.concatenate([self.ends, self.ends[-1] + np.cumsum(counts)])
        self.pairs, self.links = np.concatenate([self.pairs, pairs]), np.concatenate([self.links, links])

    def _aligned(self, lengths: np.ndarray, a: np.ndarray, b: np.ndarray) -> tuple[list[bytes], np.ndarray, tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Of pieces of so many bytes that ``a`` and ``b`` spell one after the other: their groups as text, sizes, and
        (piece, pair, links) in order."""
        end_a, end_b, ends = np.cumsum(self.a_size[a]), np.cumsum(self.b_size[b]), np.cumsum(lengths)
        both = np.intersect1d(end_a, end_b, assume_unique=True)
        in_a, in_b = np.searchsorted(both, end_a), np.searchsorted(both, end_b)
        of_a, of_b = np.bincount(in_a), np.bincount(in_b)
        to_a, to_b = np.cumsum(of_a), np.cumsum(of_b)
        piece = np.searchsorted(ends, both)
        total = lambda x: np.bincount(piece, x, len(ends)).astype(np.int64)
        sizes = np.stack([total(of_a), total(of_b), total(np.ones(len(both))), total(of_a * of_b)], 1)
        # each group's A ids, then its B ids
        parts = np.empty(len(a) + len(b), object)
        parts[np.arange(len(a)) + (to_b - of_b)[in_a]] = self.text[0][a + len(self.a_bytes) * np.isin(np.arange(1, len(a) + 1), to_a)]
        parts[np.arange(len(b)) + to_a[in_b]] = self.text[1][b + len(self.b_bytes) * np.isin(np.arange(1, len(b) + 1), to_b)]
        till = np.cumsum(sizes[:, 0] + sizes[:, 1]).tolist()
        listed = parts.tolist()
        said = [b"".join(listed[i:j]) for i, j in zip([0, *till[:-1]], till, strict=True)]
        small = of_a * of_b <= SMALL
        keep = np.flatnonzero(small[in_a])
        times = of_b[in_a[keep]]
        first = np.cumsum(times) - times
        other = np.repeat((to_b - of_b)[in_a[keep]] - first, times) + np.arange(times.sum())
        owner, pair = np.repeat(piece[in_a[keep]], times), np.repeat(a[keep], times) << self.bits[1] | b[other]
        links = np.ones(len(pair), np.int64)
        for g in np.flatnonzero(~small).tolist():
            x, n = np.unique(a[to_a[g] - of_a[g] : to_a[g]], return_counts=True)
            y, m = np.unique(b[to_b[g] - of_b[g] : to_b[g]], return_counts=True)
            pair = np.append(pair, (x[:, None] << self.bits[1] | y).ravel())
            links = np.append(links, (n[:, None] * m).ravel())
            owner = np.append(owner, np.full(len(x) * len(y), piece[g]))
        order = np.lexsort((pair, owner))
        owner, pair, links = owner[order], pair[order], links[order]
        at = np.flatnonzero(np.append(True, (owner[1:] != owner[:-1]) | (pair[1:] != pair[:-1])))
        return said, sizes, (owner[at], pair[at], np.add.reduceat(links, at))

    def documents(self, texts: list[str | None]) -> Iterator[tuple[list[tuple], tuple[np.ndarray, np.ndarray, np.ndarray]]]:
        """For some texts at once (number, n_a, n_b, n_groups, n_links, digest) of each, and (number, pair, links) of their
        records, in which a pair may come more than once."""
        for at in range(0, len(texts), TEXTS):
            some = texts[at : at + TEXTS]
            codes = self.codes([self.cut(" " + t) if t else [] for t in some])
            rows, known = [], []
            for i, c in enumerate(codes):
                sizes = self.sizes[c]
                if not len(c) or sizes[:, 0].min() < 0:
                    rows.append((at + i, 0, 0, 0, 0, ""))
                    continue
                said = b"".join(map(self.said.__getitem__, c.tolist()))[:-1]
                rows.append((at + i, *sizes.sum(0).tolist(), hashlib.sha256(said).hexdigest()))
                known.append(c | (at + i) << 32)
            where = np.sort(np.concatenate(known)) if known else np.zeros(0, np.int64)
            first = np.flatnonzero(np.append(True, where[1:] != where[:-1])) if len(where) else np.zeros(0, np.int64)
            often, where = np.diff(np.append(first, len(where))), where[first]
            code = where & 0xFFFFFFFF
            begin, n = self.ends[code], self.ends[code + 1] - self.ends[code]
            place = np.repeat(begin - (np.cumsum(n) - n), n) + np.arange(n.sum())
            yield rows, (np.repeat(where >> 32, n), self.pairs[place], self.links[place] * np.repeat(often, n))


_WORKER: dict[tuple[str, str], Pieces] = {}


def _pieces(byte_level: str, pieces: str) -> Pieces:
    """The worker's own, which stays from task to task."""
    key = byte_level, pieces
    if key not in _WORKER:
        _WORKER[key] = Pieces(byte_level, pieces)
    return _WORKER[key]


def _packed(*arrays: np.ndarray) -> bytes:
    data = b"".join(np.ascontiguousarray(x).tobytes() for x in arrays)
    return zstandard.ZstdCompressor(level=3).compress(data)


def head(pairs: np.ndarray, counts: np.ndarray) -> bytes:
    """Sorted pairs with a count of each, as blocks that can be read one by one."""
    out = []
    for at in range(0, len(pairs), HEAD_BLOCK):
        block = _packed(np.diff(pairs[at : at + HEAD_BLOCK], prepend=np.int64(0)), counts[at : at + HEAD_BLOCK].astype(np.int64))
        out += [len(block).to_bytes(4, "little"), block]
    return b"".join(out)


def head_blocks(blob: bytes) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    at, unpack = 0, zstandard.ZstdDecompressor()
    while at < len(blob):
        n = int.from_bytes(blob[at : at + 4], "little")
        data = np.frombuffer(unpack.decompress(blob[at + 4 : at + 4 + n]), np.int64)
        yield np.cumsum(data[: len(data) // 2]), data[len(data) // 2 :]
        at += 4 + n


def head_of(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    blocks = list(head_blocks(blob))
    return np.concatenate([p for p, _ in blocks]), np.concatenate([n for _, n in blocks])


def body(rows: np.ndarray, links: np.ndarray) -> bytes:
    return _packed(rows.astype(np.uint32), links.astype(np.int64))


def body_of(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    data = zstandard.ZstdDecompressor().decompress(blob)
    n = len(data) // 12
    return np.frombuffer(data, np.uint32, n), np.frombuffer(data, np.int64, n, 4 * n)


class _Spill:
    """Records of a task, and the runs made of them. A record is one number that sorts by radix bucket, A id, B id and
    document; its links stand in the last bits."""

    def __init__(self, buckets: int, run: int, bits: list[int]):
        self.run, (self.a, self.b, self.low) = run, bits
        self.radix = buckets.bit_length() - 1
        self.records: list[np.ndarray] = []
        self.size, self.first = 0, 0

    def add(self, first: int, rows: np.ndarray, pairs: np.ndarray, links: np.ndarray) -> None:
        """Records of documents from number ``first`` on."""
        if not len(pairs):
            return
        if not self.records:
            self.first = first
        a = pairs >> self.b
        turned = (a & (1 << self.radix) - 1) << max(0, self.a - self.radix) | a >> self.radix
        most = (1 << self.low) - 1
        key = (turned << self.b | pairs & (1 << self.b) - 1).astype(np.uint64) << np.uint64(64 - self.a - self.b)
        key |= (rows + (first - self.first)).astype(np.uint64) << np.uint64(self.low)
        # more links than the bits hold are several records
        while len(over := np.flatnonzero(links > most)):
            self.records.append(key[over] | np.uint64(most))
            links = np.where(links > most, links - most, links)
        self.records.append(key | links.astype(np.uint64))
        self.size += len(key)

    def full(self, till: int) -> bool:
        """Whether a run is due before document ``till``."""
        return self.size >= self.run or bool(self.records) and till - self.first > 1 << ROW_BITS

    def runs(self) -> Iterator[tuple[int, int, bytes, bytes]]:
        """(bucket, first, head, body) of what was added, which goes."""
        every = np.concatenate(self.records)
        self.records, self.size = [], 0
        every.sort()
        links = (every & np.uint64((1 << self.low) - 1)).astype(np.int64)
        every >>= np.uint64(self.low)
        at = np.flatnonzero(np.append(True, every[1:] != every[:-1]))
        every, links = every[at], np.add.reduceat(links, at)
        rows = (every & np.uint64((1 << ROW_BITS) - 1)).astype(np.uint32)
        turned = (every >> np.uint64(ROW_BITS)).astype(np.int64)
        a, rest = turned >> self.b, max(0, self.a - self.radix)
        radix = a >> rest
        pairs = ((a & (1 << rest) - 1) << self.radix | radix) << 32 | turned & (1 << self.b) - 1
        edges = np.append(np.flatnonzero(np.diff(radix, prepend=-1)), len(radix)).tolist()
        for i, j in zip(edges[:-1], edges[1:], strict=True):
            first = np.flatnonzero(np.diff(pairs[i:j], prepend=-1))
            yield int(radix[i]), self.first, head(pairs[i:j][first], np.diff(np.append(first, j - i))), body(rows[i:j], links[i:j])


COLUMNS = "row long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, bucket int, first long, head binary, body binary"


def spilled(docs: DataFrame, byte_level: str, pieces: str, buckets: int = BUCKETS, run: int = RUN) -> DataFrame:
    """COLUMNS and doc_id: a row for each document of (doc_id, text), and one for each part of a run, which has a bucket."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = _pieces(byte_level, pieces)
        spill, row, ids = _Spill(buckets, run, both.bits), TaskContext.get().partitionId() << 33, None
        for batch in batches:
            ids, out = batch["doc_id"], []
            for rows, (at, pairs, links) in both.documents(batch["text"].to_pylist()):
                first = rows[0][0]
                if spill.full(row + rows[-1][0] + 1):
                    yield _run_rows(ids, spill)
                spill.add(row + first, at - first, pairs, links)
                out += [(row + i, *rest) for i, *rest in rows]
            row += batch.num_rows
            if out:
                cols = [pa.array(c, pa.string() if k == 5 else pa.int64()) for k, c in enumerate(zip(*out, strict=True))]
                none = [pa.nulls(len(out), t) for t in (pa.int32(), pa.int64(), pa.binary(), pa.binary())]
                yield pa.RecordBatch.from_arrays([batch["doc_id"], *cols, *none], NAMES)
        if spill.size:
            yield _run_rows(ids, spill)

    return in_arrow(docs, work, f"doc_id {kind}, {COLUMNS}")


NAMES = ["doc_id", *[c.split()[0] for c in COLUMNS.split(", ")]]


def _run_rows(ids: pa.Array, spill: _Spill) -> pa.RecordBatch:
    bucket, first, heads, bodies = zip(*spill.runs(), strict=True)
    n = len(bucket)
    none = [pa.nulls(n, t) for t in (*[pa.int64()] * 5, pa.string())]
    given = [pa.array(bucket, pa.int32()), pa.array(first, pa.int64()), pa.array(heads, pa.binary()), pa.array(bodies, pa.binary())]
    return pa.RecordBatch.from_arrays([pa.nulls(n, ids.type), *none, *given], NAMES)


def _entries(blob: bytes) -> Iterator[tuple[int, int]]:
    for pairs, counts in head_blocks(blob):
        yield from zip(pairs.tolist(), counts.tolist(), strict=True)


def merged(heads: Iterable[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The pairs of sorted heads and the sums of their counts, by one heap over all heads, a block of each unpacked."""
    pairs, counts = array("q"), array("q")
    last = -1
    for pair, n in heapq.merge(*map(_entries, heads), key=itemgetter(0)):
        if pair == last:
            counts[-1] += n
        else:
            pairs.append(pair)
            counts.append(n)
            last = pair
    return np.frombuffer(pairs, np.int64), np.frombuffer(counts, np.int64)


def best_of(pairs: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Whether each of the A-major ``pairs`` has the highest count of its A id."""
    at = np.flatnonzero(np.diff(pairs >> 32, prepend=-1))
    return counts == np.repeat(np.maximum.reduceat(counts, at), np.diff(np.append(at, len(pairs)))) if len(pairs) else np.zeros(0, bool)


def pair_counts(runs: DataFrame, fan: int = FAN) -> DataFrame:
    """(bucket, head): the counts of all pairs, one row a bucket."""

    def merge(table: pa.Table) -> pa.Table:
        joined = head(*merged(h.as_py() for h in table["head"]))
        return pa.table({"bucket": table["bucket"].slice(0, 1), "head": pa.array([joined], pa.binary())})

    heads = runs.select("bucket", "head")
    while True:
        most = heads.groupBy("bucket").count().agg(F.max("count")).first()[0] or 0
        groups = max(1, -(-most // fan)) if most > fan else 1
        dealt = heads.withColumn("part", F.pmod(F.xxhash64("head"), F.lit(groups))).groupBy("bucket", "part")
        heads = written(dealt.applyInArrow(merge, "bucket int, head binary"), "pair-counts")
        if groups == 1:
            return heads


def contributions(runs: DataFrame, counts: DataFrame, fan: int = FAN) -> DataFrame:
    """(row, n_best, count_sum): what each part of a run adds to its documents."""

    def met(ours: pa.Table, totals: pa.Table) -> pa.Table:
        out = []
        if ours.num_rows:
            every, sums = head_of(totals["head"][0].as_py())
            best = best_of(every, sums)
            for first, h, b in zip(ours["first"].to_pylist(), ours["head"], ours["body"], strict=True):
                pairs, df = head_of(h.as_py())
                rows, links = body_of(b.as_py())
                at = np.repeat(np.searchsorted(every, pairs), df)
                total = np.bincount(rows, sums[at] * links)
                top = np.bincount(rows, best[at] * links)
                some = np.flatnonzero(np.bincount(rows))
                out.append((some + first, top[some].astype(np.int64), total[some].astype(np.int64)))
        cols = [np.concatenate(c) for c in zip(*out, strict=True)] if out else [np.zeros(0, np.int64)] * 3
        return pa.table(dict(zip(("row", "n_best", "count_sum"), cols, strict=True)))

    most = runs.groupBy("bucket").count().agg(F.max("count")).first()[0] or 0
    parts = max(1, -(-most // max(1, fan // 4)))
    dealt = runs.select("bucket", F.pmod(F.xxhash64("first"), F.lit(parts)).alias("part"), "first", "head", "body")
    again = counts.select("bucket", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(parts - 1).cast("long"))).alias("part"), "head")
    keys = ("bucket", "part")
    return dealt.groupBy(*keys).cogroup(again.groupBy(*keys)).applyInArrow(met, "row long, n_best long, count_sum long")


def aligned(docs: DataFrame, byte_level: str, pieces: str, buckets: int = BUCKETS, run: int = RUN, fan: int = FAN) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of every row."""
    bounded_batches(docs.sparkSession)
    both = written(spilled(renamed(docs, doc_id="doc_id", text="text"), byte_level, pieces, buckets, run), "aligned")
    rows, runs = both.where("bucket is null"), both.where("bucket is not null")
    back = contributions(runs, pair_counts(runs, fan), fan).groupBy("row").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    none = F.lit(0).cast("long")
    return rows.join(back, "row", "left").select("doc_id", "n_a", "n_b", "n_groups", "n_links", F.coalesce("n_best", none).alias("n_best"), F.coalesce("count_sum", none).alias("count_sum"), "groups_sha256")


def links(docs: DataFrame, byte_level: str, pieces: str, buckets: int = BUCKETS, run: int = RUN, fan: int = FAN) -> DataFrame:
    """(a, b, documents, best): the corpus-wide table of linked id pairs."""
    both = written(spilled(renamed(docs, doc_id="doc_id", text="text"), byte_level, pieces, buckets, run), "aligned")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for blob in batch["head"]:
                pairs, counts = head_of(blob.as_py())
                cols = [pairs >> 32, pairs & 0xFFFFFFFF, counts, best_of(pairs, counts)]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], ["a", "b", "documents", "best"])

    return in_arrow(pair_counts(both.where("bucket is not null"), fan).select("head"), read, "a long, b long, documents long, best boolean")
