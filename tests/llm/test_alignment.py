"""Cross-tokenizer alignment against the libraries and brute force."""

import hashlib
import random
from collections import Counter, defaultdict

import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from loomwork.llm import alignment

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def libraries():
    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=B)


def brute(libraries, docs):
    a, b = libraries
    alphabet = {c: bytes([x]) for c, x in alignment.byte_alphabet().items()}
    made = []
    for key, text in docs:
        ours = a.encode(" " + text, add_special_tokens=False).ids if text else []
        theirs = b.encode(text) if text else []
        x = [b"".join(alphabet.get(c, b"?") for c in a.id_to_token(i)) for i in ours]
        y = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in theirs]
        whole = (" " + text).encode() if text else b""
        if not text or b"".join(x) != whole or b"".join(y) != whole:
            made.append((key, [], [], [], ""))
            continue
        ends = lambda parts: [sum(map(len, parts[: i + 1])) for i in range(len(parts))]
        p, q = ends(x), ends(y)
        both = sorted(set(p) & set(q))
        groups, i, j = [], 0, 0
        for end in both:
            i2, j2 = p.index(end) + 1, q.index(end) + 1
            groups.append((ours[i:i2], theirs[j:j2]))
            i, j = i2, j2
        said = ";".join(",".join(map(str, g)) + "|" + ",".join(map(str, h)) for g, h in groups)
        made.append((key, ours, theirs, groups, hashlib.sha256(said.encode()).hexdigest()))
    links = [Counter((s, t) for g, h in groups for s in g for t in h) for *_, groups, _ in made]
    count = Counter(pair for c in links for pair in c)
    top = defaultdict(int)
    for (s, _), n in count.items():
        top[s] = max(top[s], n)
    out = []
    for (key, ours, theirs, groups, sha), c in zip(made, links, strict=True):
        best = sum(n for pair, n in c.items() if count[pair] == top[pair[0]])
        out.append((key, len(ours), len(theirs), len(groups), sum(c.values()), best, sum(n * count[pair] for pair, n in c.items()), sha))
    return sorted(out, key=repr), count, top


def corpus(rnd):
    word = lambda: rnd.choice(["the", "thé", "unbelievable", "don't", "x1y2", "日本", "🙂", "<|endoftext|>", "<s>", "a;\r", " ", "​", "\x1c", "　"])
    gap = lambda: rnd.choice([" ", " ", " ", "  ", "\n", "\n\n ", "\t", " \n", "\r\n", "  ", ""])
    docs = [(k, "".join(word() + gap() for _ in range(rnd.choice([1, 5, 40])))) for k in range(150)]
    docs += [(k, "".join(chr(rnd.choice([rnd.randrange(1, 128), rnd.randrange(0xA0, 0x3000), 0x20, 0x0A])) for _ in range(60))) for k in range(200, 260)]
    return docs + [(900, None), (901, ""), (902, " "), (903, "a▁b"), (None, "the end"), (904, "the " * 3000), (904, "  lead"), (5, "the end"), (905, "x" * 3000), (906, "trail  "), (907, "\n")]


@pytest.mark.parametrize(("run", "fan"), [(1 << 20, 64), (50, 2)])
def test_whole_results(spark, libraries, run, fan):
    docs = corpus(random.Random(7))
    want, count, top = brute(libraries, docs)
    frame = spark.createDataFrame([(t, "e", k, 0) for k, t in docs], "text string, row string, doc_id long, bucket int").repartition(3)
    got = alignment.aligned(frame, A, B, buckets=4, run=run, fan=fan)
    assert sorted(map(tuple, got.collect()), key=repr) == want
    if run < 100:
        pairs = {(r.a, r.b): (r.documents, r.best) for r in alignment.links(frame, A, B, buckets=4, run=run, fan=fan).collect()}
        assert pairs == {p: (n, n == top[p[0]]) for p, n in count.items()}


def test_empty_table(spark):
    assert alignment.aligned(spark.createDataFrame([], "doc_id long, text string"), A, B).count() == 0
    nothing = spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string")
    assert sorted(map(tuple, alignment.aligned(nothing, A, B).collect())) == [(i, 0, 0, 0, 0, 0, 0, "") for i in (1, 2)]
