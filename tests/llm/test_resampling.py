"""Importance resampling against brute force."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from loomwork.llm import resampling


def features(text):
    words = re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", bytes(b + 32 if 65 <= b <= 90 else b for b in (text or "").encode()))
    return len(words), [zlib.crc32(b" ".join(words[i : i + k])) % 10000 for k in (1, 2, 3) for i in range(len(words) - k + 1)]


def brute(docs, items, percent=5):
    s, t = Counter(), Counter()
    for _, text in docs:
        s.update(features(text)[1])
    for _, text in items:
        t.update(features(text)[1])
    S, T = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (S + 10000) / ((s[b] + 1) * (T + 10000)))) for b in range(10000)]
    rows = []
    for i, text in docs:
        n, found = features(text)
        weight = sum(gain[b] for b in found)
        score = None
        if i is not None:
            h = int(hashlib.sha256(f"42:{i}".encode()).hexdigest()[:8], 16)
            score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append([i, len(found), weight, score, n])
    apt = sorted((r for r in rows if r[4] >= 20 and r[3] is not None), key=lambda r: (-r[3], r[0], r[1]))
    rank = {id(r): k + 1 for k, r in enumerate(apt[: percent * len(apt) // 100])}
    return sorted(((*r[:4], rank.get(id(r))) for r in rows), key=repr)


def corpus(rnd, n):
    word = lambda: rnd.choice(["Alpha", "beta", "gämma", "x1", "Ünd", "don't", "a", "z" * 70])
    docs = [(k, rnd.choice([" ", ", ", "\n"]).join(word() for _ in range(rnd.choice([0, 1, 2, 19, 20, 21, 200])))) for k in range(n)]
    return docs + [(1000, None), (1001, ""), (1002, "!!"), (None, "beta " * 30), (3, "beta " * 25), (3, "beta " * 25), (1003, "w" * 5000 + " " + "v" * 129 + " end"), (1004, "日本語 " * 40)]


@pytest.mark.parametrize("small", [False, True])
def test_whole_results(spark, small, monkeypatch):
    if small:  # cuts inside texts, many groups and gathers
        monkeypatch.setattr(resampling, "GROUP_BYTES", 64)
        monkeypatch.setattr(resampling, "SPANS", 7)
    rnd = random.Random(5)
    docs = corpus(rnd, 300)
    items = [(k, "alpha BETA x1, a gämma " * 8) for k in range(5)] + [(9, None)]
    frame = spark.createDataFrame([(t, k, "e", 1) for k, t in docs], "text string, doc_id long, rank string, bucket int")
    got = resampling.importance(frame, spark.createDataFrame(items, "item_id long, text string"))
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert sorted(map(tuple, got.collect()), key=repr) == brute(docs, items)
    drawn = resampling.resampled(frame, spark.createDataFrame(items, "item_id long, text string"))
    assert drawn.columns == frame.columns
    assert sorted(r.doc_id for r in drawn.collect()) == sorted(r[0] for r in brute(docs, items) if r[-1])


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert resampling.importance(none, none).count() == 0
    one = spark.createDataFrame([(1, "a b " * 20)], "doc_id long, text string")
    assert [tuple(r) for r in resampling.importance(one, none).collect()] == brute([(1, "a b " * 20)], [])


@pytest.mark.parametrize("block", [1, 3, 64])
def test_position_table(block):
    rnd = np.random.default_rng(1)
    data = rnd.integers(0, 256, 5000).astype(np.uint8)
    starts = rnd.integers(0, 4000, 200)
    ends = starts + np.append(rnd.integers(1, 1000, 100), rnd.integers(1, 10, 100))
    got = resampling.PositionTable(block).crc(data, starts, ends)
    assert got.tolist() == [zlib.crc32(data[a:b].tobytes()) for a, b in zip(starts, ends, strict=True)]
