"""Context-tree weighting against brute force over whole trees."""

import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from loomwork.llm import context_tree

SPACES = b" \t\n\x0b\x0c\r"


def words_of(text):
    return bytes(b + 32 if 65 <= b <= 90 else b for b in (text or "").encode()).split()


def held(doc_id):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % 7 == 2


def steps(text, depth):
    """(bits so far, context, bit) of each decision."""
    data = b"".join(w + b" " for w in words_of(text)) + b"\xff"
    past = b"\xff" * depth + data
    for i, byte in enumerate(data):
        bits = f"{byte:08b}"
        for j in range(8):
            yield bits[:j], past[i : i + depth], int(bits[j])


def brute(docs, depth):
    """Each decision's probability is Pw with it over Pw without it, both from the whole tree."""
    seen = defaultdict(lambda: [0, 0])
    for key, text in docs:
        if not held(key):
            for prefix, context, bit in steps(text, depth):
                for d in range(depth + 1):
                    seen[prefix, context[depth - d :]][bit] += 1
    longer = defaultdict(set)
    for prefix, context in seen:
        if context:
            longer[prefix, context[1:]].add(context)
    log_kt = lambda n: math.lgamma(n[0] + 0.5) + math.lgamma(n[1] + 0.5) - math.lgamma(sum(n) + 1) - math.log(math.pi)
    plain = {}

    def log_pw(prefix, context, path, bit):
        on = path is not None and path[depth - len(context) :] == context
        if not on and (prefix, context) in plain:
            return plain[prefix, context]
        n = list(seen.get((prefix, context), [0, 0]))
        if on:
            n[bit] += 1
        out = log_kt(n)
        if len(context) < depth:
            below = longer[prefix, context] | ({path[depth - len(context) - 1 :]} if on else set())
            out = np.logaddexp(out, sum(log_pw(prefix, c, path, bit) for c in below)) - math.log(2)
        if not on:
            plain[prefix, context] = out
        return out

    base = Counter(w for key, text in docs if not held(key) for w in [*words_of(text), None])
    n, v = sum(base.values()), len(base)
    out = []
    for key, text in docs:
        tokens = [*words_of(text), None]
        score = sum(log_pw(p, b"", c, bit) - log_pw(p, b"", None, 0) for p, c, bit in steps(text, depth)) / math.log(10)
        out.append((key, held(key), len(tokens), sum(w in base for w in tokens), n, sum(math.log10((base[w] + 1) / (n + v + 1)) for w in tokens), score))
    return sorted(out, key=repr)


def near(got, want):
    assert len(got) == len(want)
    for g, w in zip(sorted(got, key=repr), want, strict=True):
        assert g[:5] == w[:5]
        assert g[5:7] == pytest.approx(w[5:], rel=1e-6, abs=1e-6)


DOCS = [(k, " ".join(random.Random(k).choice(["Abc", "abd", "é", "the", "x"]) for _ in range(k % 9))) for k in range(60)]
ODD = [(100, None), (101, ""), (102, " \n\t "), (None, "the the"), (3, "abc"), (3, "abc"), (103, "new\x0bwords here"), (104, "the " * 30)]


@pytest.mark.parametrize(("depth", "group"), [(3, 1 << 24), (4, 40)])
def test_whole_results(spark, depth, group):
    docs = DOCS + ODD
    frame = spark.createDataFrame([(t, k, "e", 1) for k, t in docs], "text string, doc_id long, kind string, grp int").repartition(3)
    got = context_tree.scored(frame, depth, shards=3, group_bytes=group, fan=2)
    near([tuple(r) for r in got.collect()], brute(docs, depth))


def test_long_texts_in_slices(spark, monkeypatch):
    monkeypatch.setattr(context_tree, "SLICE", 7)
    monkeypatch.setattr(context_tree, "BLOCK", 5)
    monkeypatch.setattr(context_tree, "KEYS", 9)
    monkeypatch.setattr(context_tree, "WAITING", 30)
    docs = [(k, t * 2) for k, t in DOCS[:20] if t]
    got = context_tree.scored(spark.createDataFrame(docs, "doc_id long, text string"), 4, shards=2)
    near([tuple(r) for r in got.collect()], brute(docs, 4))


def test_empty_tables_and_no_training_texts(spark):
    assert context_tree.scored(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    key = next(k for k in range(100) if held(k))
    got = context_tree.scored(spark.createDataFrame([(key, "ab")], "doc_id long, text string")).first()
    assert got.held_out and got.train_tokens == 0 and got.n_known == 0 and got.base_score == 0
    assert got.score == pytest.approx(4 * 8 * math.log10(0.5), rel=1e-6)  # two letters, a space and the end


def test_held_out_texts_are_predicted_better_than_by_the_unigram(spark):
    got = context_tree.scored(spark.read.parquet("/root/testdata/sf0.1/documents.parquet")).where("held_out").selectExpr("sum(score)", "sum(base_score)", "avg(bits_per_byte)").first()
    assert got[0] > got[1] and got[2] < 2.2
