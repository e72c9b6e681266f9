"""Toxicity scores from a convolutional text classifier.

Words are hashed into an embedding table; filters over one, two and three words run along the whole text; each
filter's maximum over all places goes into a logistic output. The network is trained here, in numpy, on a bounded
sample of labelled rows: the ``sample`` labelled documents of smallest id hash, of ``longest`` words at most. A fifth
of them is held back to calibrate the score to a probability and to set each language's threshold. Scoring covers all
documents and whole texts, in pieces that overlap by a filter's width; nothing but the text enters the score.

Words are runs of digits, ASCII letters (A-Z lower-cased) and bytes from 0x80. A text without words, or null, is
scored as a single padding word. Rows with a null label or id aren't learned from; of several labels for one id the
highest counts. Without both labels in the sample, the score is the share of label 1 (0 if there is none).
"""

from __future__ import annotations

import dataclasses
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomwork.llm._common import WORD_TABLE, bounded_batches, in_arrow, renamed, text_bytes

BUCKETS = 1 << 15
SIZE = 16
WIDTHS = (1, 2, 3)
FILTERS = 12
#: Bounds of the training sample: rows, and words of a document.
SAMPLE = 10_000
LONGEST = 3000
#: Words scored at once; a longer text is scored piece by piece.
PIECE = 1 << 15
THRESHOLD = 0.3
PAD = BUCKETS  # the padding word, whose embedding is zero


def held_out(doc_id: Column) -> Column:
    """Rows that are never learned from: crc32 of the id as text leaves 2 on division by 4."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def word_ids(text: bytes) -> np.ndarray:
    words = text.translate(WORD_TABLE).split()
    return np.fromiter(map(zlib.crc32, words), np.uint32, len(words)).astype(np.int32) & (BUCKETS - 1)


def _laid_out(texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All texts in one array, padding after each; where each starts and ends."""
    tail = np.full(WIDTHS[-1] - 1, PAD, np.int32)
    texts = [t if len(t) else tail[:1] for t in texts]
    size = np.array([len(t) for t in texts])
    start = np.cumsum(size + len(tail)) - size - len(tail)
    return np.concatenate([x for t in texts for x in (t, tail)]), start, start + size


@dataclasses.dataclass
class Network:
    embedding: np.ndarray  # (BUCKETS + 1, SIZE)
    filters: list[np.ndarray]  # of each width: (width, SIZE, FILTERS)
    bias: list[np.ndarray]
    out: np.ndarray
    out_bias: float

    @classmethod
    def fresh(cls, rng: np.random.Generator) -> Network:
        e = rng.normal(0, 0.05, (BUCKETS + 1, SIZE)).astype(np.float32)
        e[PAD] = 0
        w = [rng.normal(0, 0.3, (n, SIZE, FILTERS)).astype(np.float32) for n in WIDTHS]
        return cls(e, w, [np.zeros(FILTERS, np.float32) for _ in WIDTHS], rng.normal(0, 0.1, FILTERS * len(WIDTHS)).astype(np.float32), 0.0)

    def projected(self) -> list[list[np.ndarray]]:
        """What each word adds to each filter at each of its places."""
        return [[np.ascontiguousarray(self.embedding @ w[k]) for k in range(len(w))] for w in self.filters]


def _maps(table: list[list[np.ndarray]], ids: np.ndarray) -> list[np.ndarray]:
    """The filters' outputs at each place, by width."""
    tail = np.full(WIDTHS[-1] - 1, ids[-1], ids.dtype)
    shifted = np.concatenate((ids, tail))
    out = []
    for places in table:
        a = places[0][ids]
        for k in range(1, len(places)):
            a += places[k][shifted[k : k + len(ids)]]
        out.append(a)
    return out


def _fit(texts: list[np.ndarray], labels: np.ndarray, epochs: int, batch: int = 32, rate: float = 3e-3, decay: float = 1e-4, seed: int = 7) -> Network:
    """Adam on the log loss; gradients flow through each filter's maximum alone, so they are sparse."""
    rng = np.random.default_rng(seed)
    net = Network.fresh(rng)
    # one direction of the embedding starts as the words' log odds, smoothed, so that small samples suffice
    seen = np.zeros((2, BUCKETS + 1))
    for t, y in zip(texts, labels, strict=True):
        seen[int(y), np.unique(t)] += 1
    n = np.bincount(labels.astype(int), minlength=2)
    odds = np.log((seen[1] + 2) / (seen[0] + 2)) - np.log((seen[1].sum() / max(seen.sum(), 1) * (seen.sum(0)) + 2) / (seen[0].sum() / max(seen.sum(), 1) * seen.sum(0) + 2))
    net.embedding[:, 0] = odds
    net.embedding[PAD] = 0
    net.filters[0][0, 0, :2] = 1.0
    net.out[:2] = 1.0
    net.out_bias = float(np.log((n[1] + 1) / (n[0] + 1))) - 1.0
    params = [net.embedding, *net.filters, *net.bias, net.out]
    first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    bias_state, step = [0.0, 0.0], 0
    for _ in range(epochs):
        order = rng.permutation(len(texts))
        for at in range(0, len(order), batch):
            chosen = order[at : at + batch]
            ids, start, end = _laid_out([texts[i] for i in chosen])
            used, place = np.unique(ids, return_inverse=True)
            small = [[net.embedding[used] @ w[k] for k in range(len(w))] for w in net.filters]
            maps = _maps(small, place.astype(np.int64))
            peaks = [np.array([s + m[s:e].argmax(0) for s, e in zip(start, end, strict=True)]) for m in maps]
            top = [m[p, np.arange(FILTERS)] for m, p in zip(maps, peaks, strict=True)]
            hidden = np.concatenate([np.maximum(t + b, 0) for t, b in zip(top, net.bias, strict=True)], 1)
            drop = (rng.random(hidden.shape) > 0.2) / 0.8
            z = (hidden * drop) @ net.out + net.out_bias
            gap = ((1 / (1 + np.exp(-z)) - labels[chosen]) / len(chosen)).astype(np.float32)
            back = gap[:, None] * net.out * drop * (hidden > 0)
            d_embed = np.zeros((len(used), SIZE), np.float32)
            d_filters, d_bias = [], []
            padded = np.concatenate((place, np.full(WIDTHS[-1], place[-1])))
            for j, w in enumerate(net.filters):
                g = back[:, j * FILTERS : (j + 1) * FILTERS].astype(np.float32)
                d = np.zeros_like(w)
                for k in range(len(w)):
                    rows = padded[peaks[j] + k]  # (documents, filters)
                    d[k] = np.einsum("bfs,bf->sf", net.embedding[used[rows]], g)
                    np.add.at(d_embed, rows, g[..., None] * w[k].T[None])
                d_filters.append(d + decay * w)
                d_bias.append(g.sum(0))
            d_out = (gap[:, None] * hidden * drop).sum(0) + decay * net.out
            step += 1
            fix = np.sqrt(1 - 0.999**step) / (1 - 0.9**step)
            # the embedding: only the words at hand
            m, v = first[0], second[0]
            real = used != PAD
            rows, g = used[real], d_embed[real]
            m[rows] = 0.9 * m[rows] + 0.1 * g
            v[rows] = 0.999 * v[rows] + 0.001 * g * g
            net.embedding[rows] -= rate * fix * m[rows] / (np.sqrt(v[rows]) + 1e-7)
            for p, g, m, v in zip(params[1:], [*d_filters, *d_bias, d_out], first[1:], second[1:], strict=True):
                m *= 0.9
                m += 0.1 * g
                v *= 0.999
                v += 0.001 * g * g
                p -= rate * fix * m / (np.sqrt(v) + 1e-7)
            g = float(gap.sum())
            bias_state = [0.9 * bias_state[0] + 0.1 * g, 0.999 * bias_state[1] + 0.001 * g * g]
            net.out_bias -= rate * fix * bias_state[0] / (bias_state[1] ** 0.5 + 1e-7)
    return net


class Model:
    """A trained network with its calibration and its languages' thresholds."""

    def __init__(self, net: Network | None, share: float):
        self.table = net.projected() if net else []
        self.bias, self.out, self.out_bias = (np.concatenate(net.bias), net.out, net.out_bias) if net else (np.zeros(0), np.zeros(0), 0.0)
        self.share = share
        self.scale, self.shift = 1.0, 0.0
        self.thresholds: dict[str, float] = {}

    def margins(self, texts: list[np.ndarray]) -> np.ndarray:
        """The network's output for each text, before calibration."""
        step, lap = PIECE, WIDTHS[-1] - 1
        owner, pieces, last = [], [], []
        for i, t in enumerate(texts):
            for at in range(0, max(len(t), 1), step):
                owner.append(i)
                pieces.append(t[at : at + step + lap])
                last.append(at + step >= len(t))
        top = np.full((len(texts), len(self.out)), -np.inf, np.float32)
        at = 0
        while at < len(pieces):
            till, held = at, 0
            while till < len(pieces) and (till == at or held + len(pieces[till]) <= 2 * PIECE):
                held += len(pieces[till])
                till += 1
            ids, start, end = _laid_out(pieces[at:till])
            # within a text, places whose windows would run into the padding belong to the next piece
            end = np.where(last[at:till], end, start + step)
            cuts = np.stack((start, end), 1).ravel()
            peaks = np.concatenate([np.maximum.reduceat(m, cuts, 0)[::2] for m in _maps(self.table, ids)], 1)
            np.maximum.at(top, owner[at:till], peaks)
            at = till
        return np.maximum(top + self.bias, 0) @ self.out + self.out_bias

    def limits(self, langs: list[str | None]) -> np.ndarray:
        """The threshold of each row's language."""
        return np.array([self.thresholds.get(lang, THRESHOLD) for lang in langs], float)

    def scores(self, texts: list[np.ndarray]) -> np.ndarray:
        if not self.table:
            return np.full(len(texts), self.share)
        z = self.margins(texts).astype(np.float64) * self.scale + self.shift
        return 1 / (1 + np.exp(-np.clip(z, -50, 50)))


def _balanced(scores: np.ndarray, labels: np.ndarray) -> float:
    """The threshold where the two classes' shares of right answers are largest in sum, between 0.05 and 0.6."""
    tried = np.linspace(0.05, 0.6, 56)
    toxic = labels == 1
    right = [(scores[toxic] >= t).mean() + ((scores[~toxic] < t).mean() if (~toxic).any() else 0) for t in tried]
    return float(tried[int(np.argmax(right))])


def _calibrated(model: Model, texts: list[np.ndarray], labels: np.ndarray, langs: list[str]) -> None:
    """A logistic curve through the margins, by Newton steps; then each language's threshold, where the shares of toxic texts
    caught and of others left alone are largest in sum. F1, which weighs by how rare toxic texts are, lets a quarter of
    them pass."""
    z, n = model.margins(texts).astype(np.float64), len(labels)
    if 0 < labels.sum() < n:
        centre, spread = z.mean(), z.std() + 1e-9
        x = np.stack(((z - centre) / spread, np.ones(n)), 1)
        # smoothed targets keep the curve from becoming a step
        ones = labels.sum()
        target = np.where(labels == 1, (ones + 1) / (ones + 2), 1 / (n - ones + 2))
        w = np.array([1.0, np.log((ones + 1) / (n - ones + 1))])
        for _ in range(50):
            p = 1 / (1 + np.exp(-np.clip(x @ w, -50, 50)))
            w -= np.linalg.solve(x.T @ (x * (p * (1 - p))[:, None]) + 1e-3 * np.eye(2), x.T @ (p - target) + 1e-3 * w)
        if w[0] > 0:
            model.scale, model.shift = w[0] / spread, w[1] - w[0] * centre / spread
    scores, langs_ = model.scores(texts), np.array(langs, object)
    for lang in set(langs) - {None}:
        here = langs_ == lang
        p, y = scores[here], labels[here]
        if y.sum() >= 10:
            model.thresholds[lang] = _balanced(p, y)


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, longest: int = LONGEST) -> Model:
    """Learn ``labels`` (doc_id, toxic) on the texts of ``docs`` (doc_id, text, lang); held-out rows excepted. Of several
    texts of one id the least by its words' ids is learned from, of several labels the largest."""
    known = labels.where("toxic is not null and doc_id is not null").where(~held_out(F.col("doc_id")))
    known = known.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    # a bounded sample, so small enough to broadcast
    known = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    lang = F.col("lang") if "lang" in docs.columns else F.lit(None).cast("string")
    rows = docs.select("doc_id", "text", lang.alias("lang")).join(F.broadcast(known), "doc_id")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = [word_ids(text) for text in text_bytes(batch["text"])]
            data = pa.array([i.tobytes() if len(i) <= longest else None for i in ids], pa.binary())
            yield pa.RecordBatch.from_arrays([batch["doc_id"], batch["lang"], batch["toxic"].cast(pa.int32()), data], ["doc_id", "lang", "toxic", "ids"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    got = in_arrow(rows, work, f"doc_id {kind}, lang string, toxic int, ids binary").where("ids is not null").groupBy("doc_id").agg(F.min(F.struct("ids", "lang", "toxic")).alias("least")).select("doc_id", "least.*").collect()
    got = sorted(got, key=lambda r: zlib.crc32(str(r.doc_id).encode()))
    texts, y = [np.frombuffer(r.ids, np.int32) for r in got], np.array([r.toxic for r in got], float)
    if not 0 < y.sum() < len(y):
        return Model(None, float(y.mean()) if len(y) else 0.0)
    back = np.arange(len(y)) % 5 == 0
    if not 0 < y[~back].sum() < (~back).sum():
        back[:] = False
    learn = [t for t, b in zip(texts, back, strict=True) if not b]
    model = Model(_fit(learn, y[~back], epochs=int(np.clip(24_000 // len(learn), 5, 20))), float(y.mean()))
    if back.any():
        _calibrated(model, [t for t, b in zip(texts, back, strict=True) if b], y[back], [r.lang for r, b in zip(got, back, strict=True) if b])
    return model


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", lang_col: str | None = None) -> DataFrame:
    """(doc_id, score, threshold) of every row; the threshold is that of the row's language, THRESHOLD without one."""
    kind = docs.schema[id_col].dataType.simpleString()
    sent = docs.sparkSession.sparkContext.broadcast(model)
    columns = {"doc_id": id_col, "text": text_col} | ({"lang": lang_col} if lang_col else {})

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = sent.value
        for batch in batches:
            scores = m.scores([word_ids(text) for text in text_bytes(batch["text"])])
            limits = m.limits(batch["lang"].to_pylist() if lang_col else [None] * batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(scores, pa.float64()), pa.array(limits, pa.float64())], ["doc_id", "score", "threshold"])

    return in_arrow(renamed(docs, **columns), work, f"doc_id {kind}, score double, threshold double")


def judged(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, held_out, score, predicted, threshold, rejected) of every row: ``predicted`` at THRESHOLD, ``rejected``
    at the threshold of the row's language, as ``without_toxic`` has it."""
    scored = score(docs, model, lang_col="lang" if "lang" in docs.columns else None)
    at = lambda limit: (F.col("score") >= limit).cast("int")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", at(F.lit(THRESHOLD)).alias("predicted"), "threshold", at(F.col("threshold")).alias("rejected"))


def without_toxic(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` without the rows that reach their language's threshold (THRESHOLD for other languages); all columns
    are kept, and are sent through Python so that no join is needed."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    langs = docs.columns.index("lang") if "lang" in docs.columns else None
    texts = docs.columns.index("text")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = sent.value
        for batch in batches:
            scores = m.scores([word_ids(text) for text in text_bytes(batch.column(texts))])
            lang = [None] * batch.num_rows if langs is None else batch.column(langs).to_pylist()
            yield batch.filter(pa.array(scores < m.limits(lang)))

    bounded_batches(docs.sparkSession)
    return docs.mapInArrow(work, docs.schema)
