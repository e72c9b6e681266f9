"""Scoring texts by context-tree weighting, beside a smoothed unigram of words.

A text is read as its words, each with a space behind, and an end mark (byte 255, which UTF-8 never has). Every byte is
decomposed into eight binary decisions, and each decision has a context tree of its own: a node stands for the decision
(the bits of the byte so far) after up to ``DEPTH`` bytes of context. With n0 and n1 the decisions seen at a node in the
training texts, its Krichevsky-Trofimov estimate of them is Pk and its weighted probability is

    Pw = Pk at full depth, else (Pk + the product of Pw over its contexts one byte longer) / 2.

A decision is predicted by the estimates (n1 + 1/2) / (n0 + n1 + 1) along the path of its context, mixed by the trees'
posterior weights: a node's is Pk / 2Pw of what the shorter contexts leave. This is the exact mixture over all prunings
of the tree; a text's score is the sum of its decisions' log10 probabilities.

How it runs on a cluster:

1. Texts are put into groups of about ``GROUP_BYTES``. A task counts the (context, byte) keys of each group, in training
   texts, and hands over one sorted run for each shard of the keys; held-out texts' keys come with a count of zero.
   Words are counted the same way, by 64-bit hashes.
2. Runs of a shard are merged, ``FAN`` at once. Shards go by the three last bytes, so a shard holds whole subtrees.
3. Upwards: each shard reduces its subtrees to counts and products at contexts of two bytes, which Spark adds up. These at
   most 2^24 nodes (some 10^5 in practice, whatever the corpus) come to the driver, which weights the three upper levels
   and sends them back. Downwards: each shard mixes along its paths, giving log10 P of every key.
4. Each run is answered from its shard, key by key in order, and each group of texts, which gives the same keys in the
   same order again, is scored from its own runs' answers.

What is shuffled grows with the texts (their groups) and with distinct keys a group, never with a frequent key: a run has one
entry for it. No group is larger than ``GROUP_BYTES`` and one text.

Null texts count as empty: one end token. A null doc_id has the text '' and is learned from. Repeated rows and ids are
texts of their own. Very long texts are read in slices. Without training texts all predictions are 1/2. Other columns are
ignored.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomwork.llm._common import bounded_batches, in_arrow, renamed, text_bytes, written

DEPTH = 6
#: Context bytes that the driver's part of the trees has at most.
UPPER = 2
SHARDS = 32
FAN = 16
GROUP_BYTES = 16 << 20
SLICE = 1 << 20
#: Keys that are counted at once, and distinct ones that wait to be summed.
KEYS = 2 << 20
WAITING = 3 << 19
#: Keys whose nodes are held at once.
BLOCK = 1 << 19
END = b"\xff"
LOWER = bytes(b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))
CONTEXTS, WORDS = 0, 1


def held_out(doc_id: object) -> bool:
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % 7 == 2


def sliced(text: bytes) -> Iterator[tuple[list[bytes], bool]]:
    """(words, whether they are the last) of a lower-cased text, about SLICE bytes at once."""
    at = 0
    text = text.translate(LOWER)
    while len(text) - at > SLICE:
        cut = at + SLICE
        while cut < len(text) and text[cut] not in b" \t\n\x0b\x0c\r":
            cut += 1
        yield text[at:cut].split(), False
        at = cut
    yield text[at:].split(), True


class Keys:
    """Keys of texts: up to ``depth`` bytes of context, the latest first, then the byte itself."""

    def __init__(self, depth: int):
        self.depth = depth
        self.parts: list[bytes] = []
        self.owners: list[int] = []
        self.size, self.context = 0, b""

    def add(self, owner: int, words: list[bytes], last: bool, first: bool) -> bool:
        if first:
            self.context = END * self.depth
        part = self.context + b" ".join(words) + (b" " if words else b"") + END * last
        self.context = part[-self.depth :]
        self.parts.append(part)
        self.owners.append(owner)
        self.size += len(part)
        return self.size >= KEYS

    def taken(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(keys, where each part's begin, whose they are) of what was added, which goes; no part is empty."""
        n = np.array([len(p) - self.depth for p in self.parts], np.int64)
        some = n > 0
        raw = b"".join(self.parts)
        # eight bytes from each place on, the first lowest: context from its earliest byte, then the byte itself
        eight = np.ndarray(len(raw) - self.depth, "<u8", raw + bytes(8), strides=(1,))
        size = np.uint64(8 * self.depth)
        keys = eight & np.uint64((1 << 8 * self.depth) - 1)
        keys <<= np.uint64(8)
        keys |= (eight >> size) & np.uint64(255)
        begin = np.cumsum(n + self.depth) - n - self.depth
        keep = np.ones(len(keys), bool)
        keep[(begin[1:, None] - self.depth + np.arange(self.depth)).ravel()] = False  # the contexts that parts begin with
        owners = np.array(self.owners)[some]
        at = (np.cumsum(n) - n)[some]
        self.parts, self.owners, self.size = [], [], 0
        return keys[keep], at, owners


def _summed(keys: np.ndarray, counts: np.ndarray | None) -> tuple[np.ndarray, np.ndarray | None]:
    """Distinct keys in order, and the sums of their counts, if they are counted."""
    if not len(keys):
        return keys, counts
    if counts is None:
        return _counted(keys)[0], None
    order = np.argsort(keys)
    keys, counts = keys[order], counts[order]
    at = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
    return keys[at], np.add.reduceat(counts, at)


def _counted(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    keys = np.sort(keys)
    at = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
    return keys[at], np.diff(np.append(at, len(keys)))


def _shard(kind: int, keys: np.ndarray, depth: int, shards: int) -> np.ndarray:
    """Contexts go by their three last bytes, words by their hash."""
    of = keys >> np.uint64(8 * (depth - UPPER)) if kind == CONTEXTS else keys
    return ((of * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(40)) % np.uint64(shards)


#: What a key is answered with.
ANSWERS = {CONTEXTS: np.float32, WORDS: np.int64}


def _packed(x: np.ndarray) -> bytes:
    """Compressed with the first bytes of all numbers first, then the second ones, and so on."""
    planes = np.ascontiguousarray(x.view(np.uint8).reshape(len(x), x.itemsize).T)
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def _read(blob: bytes, kind: type = np.uint64) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), np.uint8)
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(planes.reshape(size, len(planes) // size).T).view(kind).ravel()


def _steps(keys: np.ndarray) -> bytes:
    return _packed(np.diff(keys, prepend=np.uint64(0)))


def _keys_of(blob: bytes) -> np.ndarray:
    return np.cumsum(_read(blob), dtype=np.uint64)


class _Group:
    """What a group of texts has of keys and words; without ``counts`` only which."""

    def __init__(self, depth: int, shards: int, counts: bool = True):
        self.depth, self.shards, self.counts = depth, shards, counts
        self.learned, self.other = Keys(depth), Keys(depth)
        self.words: Counter[bytes] = Counter()
        self.others: set[bytes] = set()
        self.counted: list[tuple[np.ndarray, np.ndarray]] = []
        self.size = 0

    def add(self, text: bytes, held: bool) -> None:
        held = held or not self.counts
        stream, first = self.other if held else self.learned, True
        for words, last in sliced(text):
            if held:
                self.others.update(words)
            else:
                self.words.update(words)
            if stream.add(0, words, last, first):
                self._count(stream)
            first = False
        if held:
            self.others.add(b"")  # the end
        else:
            self.words[b""] += 1
        self.size += len(text)

    def _count(self, stream: Keys) -> None:
        keys, n = _counted(stream.taken()[0])
        self.counted.append((keys, (n if stream is self.learned else np.zeros_like(n)) if self.counts else None))
        if sum(len(k) for k, _ in self.counted) > max(WAITING, 2 * len(self.counted[0][0])):
            self.counted = [self._contexts()]

    def _contexts(self) -> tuple[np.ndarray, np.ndarray]:
        keys, n = zip(*self.counted, strict=True)
        return _summed(np.concatenate(keys), np.concatenate(n) if self.counts else None)

    def runs_by_shard(self) -> Iterator[tuple[int, int, np.ndarray, np.ndarray | None]]:
        """(kind, shard, sorted keys, training counts): the same for the same texts in any order."""
        for stream in (self.learned, self.other):
            if stream.parts:
                self._count(stream)
        contexts, self.counted = self._contexts(), []
        said = [*self.words, *(self.others - self.words.keys())]
        hashes = np.fromiter(map(xxhash.xxh64_intdigest, said), np.uint64, len(said))
        counts = np.zeros(len(said), np.int64) if self.counts else None
        if self.counts:
            counts[: len(self.words)] = list(self.words.values())
        for kind, (keys, n) in ((CONTEXTS, contexts), (WORDS, _summed(hashes, counts))):
            shard = _shard(kind, keys, self.depth, self.shards)
            order = np.argsort(shard, kind="stable")
            keys, n, shard = keys[order], n if n is None else n[order], shard[order]
            edges = np.append(np.flatnonzero(np.append(True, shard[1:] != shard[:-1])), len(shard))
            for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
                yield kind, int(shard[a]), keys[a:b], n if n is None else n[a:b]


RUNS = [("kind", pa.int32()), ("shard", pa.int32()), ("keys", pa.binary()), ("counts", pa.binary())]


def grouped(docs: DataFrame, depth: int = DEPTH, shards: int = SHARDS, group_bytes: int = GROUP_BYTES) -> DataFrame:
    """(grp, ids, sizes, texts, kind, shard, keys, counts): a row for each group, with its texts in one, and a row for each
    of its runs, which has a kind."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    names = ["grp", "ids", "sizes", "texts", *[n for n, _ in RUNS]]

    def closed(number: int, group: _Group, ids: list[pa.Array], texts: list[bytes]) -> Iterator[pa.RecordBatch]:
        every = pa.concat_arrays(ids)
        listed = pa.ListArray.from_arrays(pa.array([0, len(every)], pa.int32()), every)
        sizes = _packed(np.array([len(t) for t in texts], np.int64))
        whole = zstandard.ZstdCompressor(level=1).compress(b"".join(texts))
        first = [pa.array([number], pa.int64()), listed, pa.array([sizes], pa.binary()), pa.array([whole], pa.binary())]
        yield pa.RecordBatch.from_arrays([*first, *[pa.nulls(1, t) for _, t in RUNS]], names)
        rows = [(kind, shard, _steps(keys), _packed(n)) for kind, shard, keys, n in group.runs_by_shard()]
        given = [pa.array(c, t) for c, (_, t) in zip(zip(*rows, strict=True), RUNS, strict=True)]
        none = [pa.nulls(len(rows), t) for t in (listed.type, pa.binary(), pa.binary())]
        yield pa.RecordBatch.from_arrays([pa.array([number] * len(rows), pa.int64()), *none, *given], names)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, group, ids, texts = TaskContext.get().partitionId() << 33, _Group(depth, shards), [], []
        for batch in batches:
            for i, (doc_id, text) in enumerate(zip(batch["doc_id"].to_pylist(), text_bytes(batch["text"]), strict=True)):
                group.add(text, held_out(doc_id))
                ids.append(batch["doc_id"].slice(i, 1))
                texts.append(text)
                if group.size >= group_bytes:
                    yield from closed(number, group, ids, texts)
                    number, group, ids, texts = number + 1, _Group(depth, shards), [], []
        if ids:
            yield from closed(number, group, ids, texts)

    return in_arrow(docs, work, f"grp long, ids array<{kind}>, sizes binary, texts binary, kind int, shard int, keys binary, counts binary")


def texts_of(sizes: bytes, texts: bytes) -> list[bytes]:
    whole, ends = zstandard.ZstdDecompressor().decompress(texts), np.cumsum(_read(sizes, np.int64)).tolist()
    return [whole[a:b] for a, b in zip([0, *ends[:-1]], ends, strict=True)]


def merged(runs: DataFrame, fan: int = FAN) -> DataFrame:
    """(kind, shard, keys, counts): the sums of all runs, one row a shard."""

    def merge(table: pa.Table) -> pa.Table:
        keys, counts = _summed(np.concatenate([_keys_of(k.as_py()) for k in table["keys"]]), np.concatenate([_read(c.as_py(), np.int64) for c in table["counts"]]))
        return pa.table({"kind": table["kind"].slice(0, 1), "shard": table["shard"].slice(0, 1), "keys": pa.array([_steps(keys)], pa.binary()), "counts": pa.array([_packed(counts)], pa.binary())})

    left = runs.select("kind", "shard", "keys", "counts")
    while True:
        most = left.groupBy("kind", "shard").count().agg(F.max("count")).first()[0] or 0
        parts = -(-most // fan) if most > fan else 1
        dealt = left.withColumn("part", F.pmod(F.xxhash64("keys", "counts"), F.lit(parts))).groupBy("kind", "shard", "part")
        left = written(dealt.applyInArrow(merge, "kind int, shard int, keys binary, counts binary"), "merged-runs")
        if parts == 1:
            return left


def lgamma(x: np.ndarray) -> np.ndarray:
    """For x of 1/2 and more, by Stirling's series beyond 8."""
    x = np.asarray(x, np.float64)
    shift = np.zeros_like(x)
    small = x < 8
    for _ in range(8):
        shift -= np.where(small, np.log(x), 0)
        x = np.where(small, x + 1, x)
    return shift + (x - 0.5) * np.log(x) - x + 0.5 * np.log(2 * np.pi) + 1 / (12 * x) - 1 / (360 * x**3) + 1 / (1260 * x**5)


def log_kt(n0: np.ndarray, n1: np.ndarray) -> np.ndarray:
    """The logarithm of the estimate of n0 and n1 decisions in any one order."""
    return lgamma(n0 + 0.5) + lgamma(n1 + 0.5) - lgamma(n0 + n1 + 1) - np.log(np.pi)


def _weighted(own: np.ndarray, longer: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(log Pw, posterior weight of stopping) from log Pk and the sum of the longer contexts' log Pw."""
    return np.logaddexp(own, longer) - np.log(2), 1 / (1 + np.exp(np.clip(longer - own, -700, 700)))


def _shorter(nodes: np.ndarray) -> np.ndarray:
    """The node of the same decision whose context lacks the earliest byte."""
    return (nodes >> np.uint64(16) << np.uint64(8)) | (nodes & np.uint64(255))


class Level:
    """The nodes of one context length."""

    def __init__(self, nodes: np.ndarray, n0: np.ndarray, n1: np.ndarray, longer: np.ndarray | None):
        self.nodes, self.n0, self.n1 = nodes, n0, n1
        own = log_kt(n0, n1)
        self.p1 = (n1 + 0.5) / (n0 + n1 + 1)
        if longer is None:
            self.log_pw, self.stop = own, np.ones(len(nodes))
        else:
            self.log_pw, self.stop = _weighted(own, longer)

    def reduced(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(nodes one byte shorter, n0, n1, sum of log Pw, of which each node here is one part)."""
        shorter, of = np.unique(_shorter(self.nodes), return_inverse=True)
        total = lambda x: np.bincount(of, x, len(shorter))
        return shorter, total(self.n0), total(self.n1), total(self.log_pw), of

    def mixed(self, known: np.ndarray, left: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(P of a one, weight left) from those of each node's shorter context."""
        return known + left * self.stop * self.p1, left * (1 - self.stop)


class Subtrees:
    """All nodes of some sorted keys, which must hold whole subtrees of UPPER + 1 context bytes."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray, depth: int):
        byte, context = keys & np.uint64(255), keys >> np.uint64(8) << np.uint64(8)
        #: by bit: the place of each key's node, and the bit
        self.place: list[np.ndarray] = []
        self.bits: list[np.ndarray] = []
        nodes, zeros, ones, size = [], [], [], 0
        for j in range(8):
            node = context | np.uint64(1 << j) | (byte >> np.uint64(8 - j))
            bit = ((byte >> np.uint64(7 - j)) & np.uint64(1)).astype(bool)
            new = np.append(True, node[1:] != node[:-1])
            at = np.flatnonzero(new)
            n1 = np.add.reduceat(counts * bit, at)
            nodes.append(node[at])
            ones.append(n1)
            zeros.append(np.add.reduceat(counts, at) - n1)
            self.place.append(np.cumsum(new) - 1 + size)
            self.bits.append(bit)
            size += len(at)
        self.levels = [Level(*(np.concatenate(x) for x in (nodes, zeros, ones)), None)]
        self.of: list[np.ndarray] = []
        for _ in range(depth - UPPER - 1):
            *shorter, of = self.levels[-1].reduced()
            self.levels.append(Level(*shorter))
            self.of.append(of)
        *self.top, of = self.levels[-1].reduced()
        self.of.append(of)

    def log_p(self, upper: tuple[np.ndarray, np.ndarray, np.ndarray]) -> np.ndarray:
        """log10 P of each key's byte, given (nodes, P of a one, weight left) of the upper trees."""
        at = np.searchsorted(upper[0], self.top[0])
        p, left = upper[1][at], upper[2][at]
        for level, of in zip(reversed(self.levels), reversed(self.of), strict=True):
            p, left = level.mixed(p[of], left[of])
        out = np.zeros(len(self.bits[0]))
        for place, bit in zip(self.place, self.bits, strict=True):
            one = p[place]
            out += np.log10(np.where(bit, one, 1 - one))
        return out


def _blocks(keys: np.ndarray, counts: np.ndarray, depth: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Some BLOCK keys at once, cut where a subtree begins."""
    tree = keys >> np.uint64(8 * (depth - UPPER))
    starts = np.flatnonzero(np.append(True, tree[1:] != tree[:-1]))
    at = 0
    while at < len(keys):
        later = starts[np.searchsorted(starts, at + BLOCK) :]
        till = int(later[0]) if len(later) else len(keys)
        yield keys[at:till], counts[at:till]
        at = till


def upper_trees(nodes: np.ndarray, n0: np.ndarray, n1: np.ndarray, longer: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(nodes, P of a one, weight left) at UPPER context bytes, sorted, from their counts and longer contexts' log Pw."""
    if not len(nodes):
        return nodes, n0, n0
    order = np.argsort(nodes)
    levels, of = [Level(nodes[order], n0[order], n1[order], longer[order])], []
    for _ in range(UPPER):
        *shorter, part = levels[-1].reduced()
        levels.append(Level(*shorter))
        of.append(part)
    root = levels[-1]
    p, left = root.mixed(np.zeros(len(root.nodes)), np.ones(len(root.nodes)))
    for level, part in zip(reversed(levels[:-1]), reversed(of), strict=True):
        p, left = level.mixed(p[part], left[part])
    return levels[0].nodes, p, left


def trained(shards: DataFrame, depth: int = DEPTH) -> DataFrame:
    """(kind, shard, keys, answers): log10 P of each key of the contexts, and the training count of each word."""
    contexts, words = shards.where(F.col("kind") == CONTEXTS), shards.where(F.col("kind") == WORDS)

    def up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k, c in zip(batch["keys"], batch["counts"], strict=True):
                for block in _blocks(_keys_of(k.as_py()), _read(c.as_py(), np.int64), depth):
                    nodes, *sums = Subtrees(*block, depth).top
                    yield pa.RecordBatch.from_arrays([pa.array(nodes.astype(np.int64)), *map(pa.array, sums)], ["node", "n0", "n1", "longer"])

    partial = in_arrow(contexts.select("keys", "counts"), up, "node long, n0 double, n1 double, longer double")
    table = partial.groupBy("node").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"), F.sum("longer").alias("longer")).toArrow()
    node, *sums = (table[c].to_numpy() for c in ("node", "n0", "n1", "longer"))
    sent = shards.sparkSession.sparkContext.broadcast(upper_trees(node.astype(np.uint64), *sums))

    def down(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for k, c in zip(batch["keys"], batch["counts"], strict=True):
                blocks = _blocks(_keys_of(k.as_py()), _read(c.as_py(), np.int64), depth)
                out.append(_packed(np.concatenate([Subtrees(*block, depth).log_p(sent.value) for block in blocks]).astype(ANSWERS[CONTEXTS])))
            yield pa.RecordBatch.from_arrays([batch["kind"], batch["shard"], batch["keys"], pa.array(out, pa.binary())], ["kind", "shard", "keys", "answers"])

    model = in_arrow(contexts, down, "kind int, shard int, keys binary, answers binary")
    return written(model.unionByName(words.withColumnRenamed("counts", "answers")), "context-trees")


def word_totals(shards: DataFrame) -> tuple[int, int]:
    """All training tokens, and the distinct ones."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = v = 0
        for batch in batches:
            for c in batch["counts"]:
                counts = _read(c.as_py(), np.int64)
                n, v = n + int(counts.sum()), v + int((counts > 0).sum())
        yield pa.RecordBatch.from_pydict({"n": [n], "v": [v]})

    total = in_arrow(shards.where(F.col("kind") == WORDS).select("counts"), work, "n long, v long").agg(F.sum("n"), F.sum("v")).first()
    return total[0] or 0, total[1] or 0


def answered(runs: DataFrame, model: DataFrame, fan: int = FAN) -> DataFrame:
    """(grp, kind, shard, answers): the model's answers to the keys of each run, in their order."""

    def answer(ours: pa.Table, theirs: pa.Table) -> pa.Table:
        out = []
        if ours.num_rows:
            every, values = _keys_of(theirs["keys"][0].as_py()), _read(theirs["answers"][0].as_py(), ANSWERS[ours["kind"][0].as_py()])
            out = [_packed(values[np.searchsorted(every, _keys_of(k.as_py()))]) for k in ours["keys"]]
        return pa.table({"grp": ours["grp"], "kind": ours["kind"], "shard": ours["shard"], "answers": pa.array(out, pa.binary())})

    most = runs.groupBy("kind", "shard").count().agg(F.max("count")).first()[0] or 0
    parts = max(1, -(-most // (4 * fan)))  # runs aren't held together here
    keys = ("kind", "shard", "part")
    dealt = runs.select("grp", "kind", "shard", "keys", F.pmod(F.xxhash64("grp"), F.lit(parts)).alias("part"))
    again = model.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(parts - 1).cast("long"))))
    return dealt.groupBy(*keys).cogroup(again.groupBy(*keys)).applyInArrow(answer, "grp long, kind int, shard int, answers binary")


class Known:
    """Values by key. A key stands beside its value where its hash says, in one of two tables, or is found by search."""

    MIX = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)

    def __init__(self, parts: list[tuple[np.ndarray, np.ndarray]]):
        keys, values = (np.concatenate(x) for x in zip(*parts, strict=True))
        order = np.argsort(keys)
        self.keys, self.values = keys[order], values[order]
        self.tables = []
        keys, values = self.keys, self.values
        for mix in self.MIX:
            bits = max(8, len(keys).bit_length() + 1)
            at = self._slots(keys, mix, bits)
            # a slot that no key has holds one that isn't looked for there
            held, given = np.full(1 << bits, self.keys[0]), np.full(1 << bits, self.values[0])
            held[at], given[at] = keys, values
            self.tables.append((mix, bits, held, given))
            lost = held[at] != keys
            keys, values = keys[lost], values[lost]
        self.left = keys, values

    @staticmethod
    def _slots(keys: np.ndarray, mix: int, bits: int) -> np.ndarray:
        return ((keys * np.uint64(mix)) >> np.uint64(64 - bits)).view(np.int64)

    def of(self, keys: np.ndarray) -> np.ndarray:
        (mix, bits, held, given), second = self.tables
        at = self._slots(keys, mix, bits)
        out = given[at]
        missed = np.flatnonzero(held[at] != keys)
        if len(missed):
            mix, bits, held, given = second
            some = keys[missed]
            at = self._slots(some, mix, bits)
            out[missed] = given[at]
            still = held[at] != some
            missed, some = missed[still], some[still]
            if len(missed):
                out[missed] = self.left[1][np.searchsorted(self.left[0], some)]
        return out


SCORES = "held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double, bits_per_byte double"


def scored(docs: DataFrame, depth: int = DEPTH, shards: int = SHARDS, group_bytes: int = GROUP_BYTES, fan: int = FAN) -> DataFrame:
    """doc_id and SCORES of every row: whether it was left out of training, its tokens (words and the end), how many of them
    training has, training's tokens, log10 P by the smoothed unigram and by the trees, and the trees' code length."""
    bounded_batches(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()
    both = written(grouped(renamed(docs, doc_id="doc_id", text="text"), depth, shards, group_bytes), "text-groups")
    groups, runs = both.where("kind is null").select("grp", "ids", "sizes", "texts"), both.where("kind is not null")
    counts = merged(runs, fan)
    total, distinct = word_totals(counts)
    back = answered(runs, trained(counts, depth), fan)

    def score(ours: pa.Table, answers: pa.Table) -> pa.Table:
        ids = ours["ids"].combine_chunks().flatten()
        texts = texts_of(ours["sizes"][0].as_py(), ours["texts"][0].as_py())
        held = [held_out(i) for i in ids.to_pylist()]
        group = _Group(depth, shards, counts=False)
        for text in texts:
            group.add(text, False)
        said = {(kind, shard): _read(a.as_py(), ANSWERS[kind]) for kind, shard, a in zip(answers["kind"].to_pylist(), answers["shard"].to_pylist(), answers["answers"], strict=True)}
        parts: dict[int, list] = {CONTEXTS: [], WORDS: []}
        for kind, shard, keys, _ in group.runs_by_shard():
            parts[kind].append((keys, said[kind, shard]))
        every = list(group.others)
        del group, said
        counted = Known(parts.pop(WORDS)).of(np.fromiter(map(xxhash.xxh64_intdigest, every), np.uint64, len(every)))
        trees = Known(parts.pop(CONTEXTS))
        number = dict(zip(every, range(len(every)), strict=True))
        each = np.log10((counted + 1) / (total + distinct + 1))
        log_p, base, size, tokens, known = (np.zeros(len(texts)) for _ in range(5))
        stream = Keys(depth)

        def read() -> None:
            keys, at, owners = stream.taken()
            np.add.at(log_p, owners, np.add.reduceat(trees.of(keys), at, dtype=np.float64))
            np.add.at(size, owners, np.diff(np.append(at, len(keys))))

        for i, text in enumerate(texts):
            first = True
            for found, last in sliced(text):
                if stream.add(i, found, last, first):
                    read()
                first = False
                if last:
                    found.append(b"")  # the end
                places = np.fromiter(map(number.__getitem__, found), np.int64, len(found))
                base[i] += each[places].sum()
                tokens[i] += len(places)
                known[i] += np.count_nonzero(counted[places])
        if stream.parts:
            read()
        numbers = {"n_tokens": tokens, "n_known": known, "train_tokens": np.full(len(texts), total)}
        return pa.table({"doc_id": ids, "held_out": pa.array(held, pa.bool_()), **{c: pa.array(x.astype(np.int64)) for c, x in numbers.items()}, "base_score": base, "score": log_p, "bits_per_byte": -log_p / np.log10(2) / np.maximum(size, 1)})

    return groups.groupBy("grp").cogroup(back.groupBy("grp")).applyInArrow(score, f"doc_id {kind}, {SCORES}")
