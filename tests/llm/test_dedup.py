"""SimHash, line and substring dedup against brute force on small fixtures with every odd case."""

import hashlib
import random

import numpy as np
import pandas as pd
import pytest
import xxhash
from pyspark.sql import functions as F

from loomwork.llm import lines, shingles, simhash, substring
from loomwork.llm.components import connected_components

KIND = "doc_id long, text string, fp string, node string"
ODD = [(900, None), (901, ""), (902, " \t\n\n "), (903, "one"), (904, "one"), (904, "one"), (905, "w " * 3000)]


def frame(spark, rows):
    """With further columns whose names clash with the operators' own."""
    return spark.createDataFrame([(k, t, "x", None) for k, t in rows], KIND)


def fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(b" ".join(words[i : i + 3]), 42) for i in range(max(1, len(words) - 2))]
    return sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hashes) > len(hashes))


def test_simhash_groups(spark):
    rnd = random.Random(1)
    base = [[rnd.choice("abcdefghijklmnop") * 3 for _ in range(150)] for _ in range(4)]
    rows = list(ODD)
    for k in range(60):
        words = list(rnd.choice(base))
        for _ in range(rnd.randint(0, 2)):
            words[rnd.randrange(150)] = rnd.choice("XYZ")
        rows.append((k, " ".join(words)))
    fps = {k: fingerprint(t) for k, t in rows}
    root = {k: k for k in fps}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in fps:
        for b in fps:
            if (fps[a] ^ fps[b]).bit_count() <= 2:
                x, y = sorted((find(a), find(b)))
                root[y] = x
    got = simhash.near_duplicates(frame(spark, [*rows, (None, "alone in its group"), (None, "one")])).collect()
    assert len(got) == len(rows) + 2
    for r in got:
        if r.doc_id is not None:
            assert (r.fingerprint, r.component_id) == (f"{fps[r.doc_id]:016x}", find(r.doc_id))
    nameless = sorted(str(r.component_id) for r in got if r.doc_id is None)
    assert nameless == ["903", "None"]
    assert {r.doc_id for r in simhash.one_of_each(frame(spark, rows)).collect()} == {find(k) for k in fps}


def test_simhash_empty(spark):
    assert simhash.near_duplicates(frame(spark, [])).count() == 0


@pytest.mark.parametrize("rows", [7, 2000])
def test_index_finds_all_links_when_nodes_are_split(spark, monkeypatch, rows):
    """With batches that end within nodes, and with whole nodes in a batch."""
    monkeypatch.setattr(simhash, "NODE", 256)
    monkeypatch.setattr("loomwork.llm._common.BATCH_ROWS", rows)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 10_000)
    rng = np.random.default_rng(0)
    base = int(rng.integers(0, 2**63))
    codes = {base}
    while len(codes) < 1500:
        low = sum(1 << int(k) for k in rng.choice(24, rng.integers(0, 6), replace=False))
        codes.add(base ^ (low if rng.random() < 0.5 else low << 20))
    codes = np.array(sorted(codes), np.uint64)
    near = np.argwhere(np.triu(np.bitwise_count(codes[:, None] ^ codes[None, :]) <= 2, 1))
    want = {tuple(sorted(p)) for p in codes[near].view(np.int64).tolist()}
    got = {tuple(sorted(r)) for r in simhash.links(spark.createDataFrame(pd.DataFrame({"fp": codes.view(np.int64)}))).collect()}
    assert got == want


def test_gray_rank_is_the_inverse_of_the_code():
    n = np.arange(5000, dtype=np.uint64)
    assert (simhash.gray_rank(n ^ (n >> np.uint64(1))) == n).all()


def test_gray_order_of_the_cluster(spark):
    """Each node is whole in one partition, and its fingerprints stand in Gray order there."""
    rng = np.random.default_rng(1)
    codes = np.unique(rng.integers(0, 2**16, 800).astype(np.uint64) * np.uint64(0x1000100010001))
    fps = spark.createDataFrame(pd.DataFrame({"fp": codes.view(np.int64)}))
    rows = simhash._in_gray_order(simhash._filed(fps)).withColumn("part", F.spark_partition_id()).toPandas()
    assert len(rows) == 6 * len(codes)
    rows["node"] = rows["fp"] & rows["mask"]
    assert rows.groupby(["mask", "node"])["part"].nunique().max() == 1
    for _, node in rows.groupby(["mask", "node"]):
        rank = simhash.gray_rank(node["fp"].to_numpy().view(np.uint64)).view(np.int64)
        assert (np.diff(rank) > 0).all()


def test_components(spark):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, 101), (101, 100), (7, 7), (102, 101)]
    got = dict(connected_components(spark.createDataFrame(edges, "a long, b long")).collect())
    assert got == {**dict.fromkeys(range(41), 0), 100: 100, 101: 100, 102: 100}


def cut_lines(rows, share=0.8):
    seen, gone = [], set()
    for k, text in sorted((r for r in rows if r[1] is not None and r[0] is not None), key=lambda r: r[0]):
        for i, line in enumerate(text.split("\n")):
            words = frozenset(line.encode().split())
            if words:
                if any(len(words & w) >= share * len(words | w) - 1e-12 for at, w in seen if at != (k, i)):
                    gone.add((k, i))
                seen.append(((k, i), words))
    return {(k, t): None if t is None else "\n".join(x for i, x in enumerate(t.split("\n")) if (k, i) not in gone) for k, t in rows}


@pytest.mark.parametrize(("apart", "often"), [(1, 1024), (-1, 1), (1 << 50, 50)])
def test_lines(spark, monkeypatch, apart, often):
    """Ids near each other, descending below zero, and too far apart for places to be longs; no, all or some tokens
    meet their earliest class first."""
    monkeypatch.setattr(lines, "OFTEN", often)
    rnd = random.Random(5)
    vocabulary = [f"w{i}" for i in range(60)]
    base = [[rnd.choice(vocabulary) for _ in range(rnd.randint(1, 25))] for _ in range(12)]
    rows = list(ODD) + [(None, "w1 w2 w3")]
    for k in range(120):
        text = []
        for _ in range(rnd.randint(0, 4)):
            words = list(rnd.choice(base))
            for _ in range(rnd.randint(0, 3)):
                words[rnd.randrange(len(words))] = rnd.choice(vocabulary)
            text.append(" ".join(words))
        rows.append((k, "\n".join(text)))
    rows = [(k and k * apart, t) for k, t in rows]
    want = cut_lines(list(dict.fromkeys(rows)))
    got = lines.without_lines(frame(spark, rows))
    assert got.columns == ["doc_id", "text", "fp", "node", "n_lines", "n_removed"]
    got = got.collect()
    assert len(got) == len(rows)
    by_id = {k: v for (k, _), v in want.items()}
    assert all(r.text == by_id[r.doc_id] for r in got)


def test_lines_of_templates(spark, monkeypatch):
    """Lines that differ in as many rare words as keep them from being similar don't meet under their template's words;
    those that differ in fewer are found whatever their sizes."""
    monkeypatch.setattr(lines, "OFTEN", 8)
    rows, k = [], 0
    for size in (1, 3, 4, 5, 7, 8, 9, 12, 17, 18, 25, 40, 100, 140):
        for own in (1, 2, 5):
            for copy in range(3):
                rows.append((k, " ".join([f"t{i}" for i in range(size)] + [f"x{k}y{i}" for i in range(own if copy else 1)])))
                k += 1
    want = cut_lines(rows)
    got = {(r.doc_id, r.text) for r in lines.without_lines(spark.createDataFrame(rows, "doc_id long, text string")).select("doc_id", "text").collect()}
    assert got == {(i, text) for (i, _), text in want.items()}


def test_lines_of_a_template_meet_no_pairs(spark, monkeypatch):
    """30,000 different lines of two templates of like size make hardly a pair (all would be 450 million): some words share
    the bucket of a common one."""
    met = []
    verified = lines._verified
    monkeypatch.setattr(lines, "_verified", lambda scratch, name, pairs, *rest: met.append(pairs.count()) or verified(scratch, name, pairs, *rest))
    text = F.concat(F.lit("alpha beta gamma delta "), F.when(F.col("doc_id") % 2 == 0, "").otherwise("epsilon "), F.lit("x"), F.col("doc_id"))
    docs = spark.range(30_000).withColumnRenamed("id", "doc_id").withColumn("text", text)
    assert lines.later_matches(docs).count() == 0
    assert sum(met) < 100


def test_lines_rare_words_stay_rare(spark, monkeypatch):
    """1.2 million words that stand once each: the buckets that they share make hardly one look frequent."""
    monkeypatch.setattr(lines, "OFTEN", 12)
    words = F.array_join(F.transform(F.sequence(F.lit(0), F.lit(19)), lambda i: F.concat(F.lit("x"), F.col("doc_id") * 20 + i)), " ")
    docs = spark.range(60_000).withColumnRenamed("id", "doc_id").withColumn("text", words)
    keyed = lines.keyed_lines(lines.Places(docs).split(docs), lines._levels(docs))
    often = keyed.where(F.element_at("prefix", -1) >= lines._least_code(12)).count()
    assert often < 600


def test_lines_are_dealt_out_once(spark, monkeypatch):
    """The join of classes on rare tokens reads one shuffle twice."""
    plans = []
    kept = lines.Scratch.written

    def noted(scratch, df, name):
        if name == "second_pairs":
            df.collect()
            plans.append(df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0])
        return kept(scratch, df, name)

    monkeypatch.setattr(lines.Scratch, "written", noted)
    monkeypatch.setattr(lines, "OFTEN", 8)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        docs = spark.createDataFrame([(k, f"t{k // 2} u{k // 2} v{k // 2} w{k // 2} common x{k % 2}") for k in range(60)], "doc_id long, text string")
        assert lines.later_matches(docs, 0.6).count() == 30
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert len(plans) == 1 and "ReusedExchange" in plans[0]


def test_lines_of_any_columns_and_copies(spark):
    """Column names that an operator may use, rows of one id, and counts that are replaced."""
    rows = [(1, "a b c d e\nx", 7), (1, "a b c d e\nx", 7), (2, "e d c b a\ny", 8), (2, "other\nx", 9), (3, None, 1)]
    docs = spark.createDataFrame([(*r, "p", "q", 5) for r in rows], "_doc long, _gone string, n_lines long, __m string, ___n string, n_removed long")
    got = lines.without_lines(docs, id_col="_doc", text_col="_gone")
    assert got.columns == ["_doc", "_gone", "__m", "___n", "n_lines", "n_removed"]
    found = sorted((r["_doc"], r["_gone"], r.n_lines, r.n_removed) for r in got.collect() if r["_gone"] is not None)
    # of document 2 each text loses its own lines only
    assert found == [(1, "a b c d e\nx", 2, 0), (1, "a b c d e\nx", 2, 0), (2, "other", 2, 1), (2, "y", 2, 1)]


def test_lines_of_a_long_document(spark):
    """Time is in proportion: 300,000 lines of which all but two go."""
    rows = [(1, "\n".join(["first line of all"] * 150_000 + ["quite another line"] + ["first line of all"] * 150_000)), (2, "x")]
    got = {r.doc_id: r for r in lines.without_lines(frame(spark, rows)).collect()}
    assert (got[1].text, got[1].n_lines, got[1].n_removed) == ("first line of all\nquite another line", 300_001, 299_999)
    assert (got[2].text, got[2].n_removed) == ("x", 0)


def test_lines_of_a_hot_group(spark):
    """Thousands of near copies of one line, each of another token set, take no pair of each other."""
    words = [f"w{i}" for i in range(30)]
    rows = [(k, " ".join(words[:k % 30] + [f"x{k}"] + words[k % 30 + 1 :])) for k in range(3000)]
    got = lines.without_lines(frame(spark, rows)).agg({"n_removed": "sum"}).first()[0]
    assert got == 2999


def test_lines_of_ids_with_several_texts(spark):
    rnd = random.Random(8)
    line = lambda: " ".join(rnd.choice("abcdefg") for _ in range(rnd.randint(1, 6)))
    rows = [(rnd.randrange(8), "\n".join(line() for _ in range(4))) for _ in range(30)] + [(3, None), (3, ""), (None, "a b c")]
    rows += rows[:5]
    docs = frame(spark, rows)
    versions = {(r.doc_id, r.text): r.v for r in docs.select("doc_id", "text", F.xxhash64("text").alias("v")).collect()}
    order = sorted({r for r in rows if r[0] is not None}, key=lambda r: (r[0], versions[r]))
    want = cut_lines([(i, t) for i, (_, t) in enumerate(order)])
    by_row = {row: want[i, row[1]] for i, row in enumerate(order)} | {(None, "a b c"): "a b c"}
    got = [(r.doc_id, r.text) for r in lines.without_lines(docs).collect()]
    assert sorted(got, key=repr) == sorted(((k, by_row[k, t]) for k, t in rows), key=repr)


def test_lines_ids(spark):
    with pytest.raises(TypeError):
        lines.without_lines(spark.createDataFrame([("a", "w1")], "doc_id string, text string"))


def test_lines_empty(spark):
    assert lines.without_lines(frame(spark, [])).count() == 0


def cut_repeats(rows, length):
    first = {}
    for k, text in rows:
        words = (text or "").encode().split()
        for i in range(len(words) - length + 1):
            window = tuple(words[i : i + length])
            first[window] = min(first.get(window, k), k)
    out = {}
    for k, text in rows:
        words = (text or "").encode().split()
        gone = [False] * len(words)
        for i in range(len(words) - length + 1):
            if first[tuple(words[i : i + length])] < k:
                gone[i : i + length] = [True] * length
        kept = b" ".join(w for w, g in zip(words, gone, strict=True) if not g)
        out[k] = (len(words), sum(gone), hashlib.sha256(kept).hexdigest())
    return out


@pytest.mark.parametrize("length", [7, 12])
def test_repeats(spark, length):
    rnd = random.Random(3)
    base = [[rnd.choice("abc") for _ in range(60)] for _ in range(4)]
    rows = list(ODD)
    for k in range(120):
        words = []
        for _ in range(rnd.randint(0, 5)):
            if rnd.random() < 0.6:
                part = list(rnd.choice(base))[rnd.randint(0, 20) : rnd.randint(30, 60)]
                if rnd.random() < 0.4:
                    part[rnd.randrange(len(part))] = "z"
                words += part
            else:
                words += [rnd.choice("abcdefgh") for _ in range(rnd.randint(1, 30))]
        rows.append((k, " ".join(words)))
    want = cut_repeats(rows, length)
    got = substring.without_repeats(frame(spark, [*rows, (None, "a b c " * 20)]), length).collect()
    assert len(got) == len(rows) + 1
    for r in got:
        if r.doc_id is not None:
            assert (r.n_words, r.n_removed, r.kept_sha256) == want[r.doc_id]
            assert hashlib.sha256(r.kept.encode()).hexdigest() == r.kept_sha256
        else:
            assert r.n_removed == 0


def test_repeats_of_ids_with_several_texts(spark):
    """Each row loses what its own text repeats of smaller ids, whatever other rows of its id hold."""
    rnd = random.Random(4)
    words = lambda n: [rnd.choice("abcdefghijklmnop") for _ in range(n)]
    a, b, c = words(30), words(30), words(30)
    rows = [(1, a), (5, a), (5, b), (5, b), (5, words(9) + a[3:25] + c), (5, c + words(4)), (7, c + b), (7, c), (5, a)]
    rows = [(k, " ".join(w)) for k, w in rows]
    length, first = 8, {}
    for k, text in rows:
        w = text.split()
        for i in range(len(w) - length + 1):
            key = tuple(w[i : i + length])
            first[key] = min(first.get(key, k), k)
    want = []
    for k, text in rows:
        w = text.split()
        gone = {j for i in range(len(w) - length + 1) if first[tuple(w[i : i + length])] < k for j in range(i, i + length)}
        want.append((k, " ".join(x for j, x in enumerate(w) if j not in gone)))
    got = [(r.doc_id, r.kept) for r in substring.without_repeats(frame(spark, rows), length).collect()]
    assert sorted(got) == sorted(want) and (5, rows[2][1]) in got


def test_maximal_repeats(spark):
    rnd = random.Random(6)
    base, length = [rnd.choice("abcd") for _ in range(80)], 7
    rows = []
    for k in range(60):
        words = []
        for _ in range(rnd.randint(1, 4)):
            i = rnd.randint(0, 60)
            words += base[i : i + rnd.randint(3, 20)] if rnd.random() < 0.6 else [rnd.choice("efghijkl") for _ in range(rnd.randint(1, 9))]
        rows.append((k, words))
    first, want = {}, []
    for k, w in rows:
        for i in range(len(w) - length + 1):
            first.setdefault(tuple(w[i : i + length]), k)
    for k, w in rows:
        gone = [any(first[tuple(w[i : i + length])] < k for i in range(max(0, j - length + 1), min(j, len(w) - length) + 1)) for j in range(len(w))]
        edges = [j for j in range(len(w) + 1) if (j < len(w) and gone[j]) != (j > 0 and gone[j - 1])]
        want += [(k, a, b) for a, b in zip(edges[::2], edges[1::2], strict=True)]
    docs = frame(spark, [(k, " ".join(w)) for k, w in rows])
    assert sorted((r.doc_id, r.start, r.end) for r in substring.maximal_repeats(docs, length).collect()) == want
    assert substring.maximal_repeats(frame(spark, []), length).isEmpty()


def test_repeats_empty(spark):
    assert substring.digests(frame(spark, [])).count() == 0


def test_one_of_each_of_columns_with_any_names(spark):
    rows = [(1, "a b c d e f", "x"), (2, "a b c d e f", "y"), (3, "something else", "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _row string").withColumns({"__ROW": F.lit(1), "key": F.lit(2), "node": F.lit(3)})
    for one_of_each in (simhash.one_of_each, shingles.one_of_each):
        got = one_of_each(docs)
        assert got.columns == docs.columns
        assert sorted((r.doc_id, r["_row"]) for r in got.collect()) == [(1, "x"), (3, "z")]


def test_one_of_each_whatever_the_ids(spark):
    rows = [(1, "a b c d"), (1, "a b c d"), (1, "quite another text"), (2, "a b c d"), (None, "a b c d"), (None, "no id has this"), (None, "no id has this"), (None, None)]
    got = sorted((r.doc_id or 0, r.text or "") for r in simhash.one_of_each(frame(spark, rows)).collect())
    assert got == [(0, ""), (0, "no id has this"), (1, "a b c d"), (1, "quite another text")]


def test_near_dedup_links_by_simhash_first(spark, monkeypatch):
    """Without what min-hashes add, documents of a group that the SimHash index links are one; farther copies stay."""
    rnd = random.Random(5)
    base = [f"w{rnd.randrange(5000)}" for _ in range(3000)]
    close = list(base)
    close[1500] = "changed"
    far = list(base)
    for at in rnd.sample(range(3000), 60):
        far[at] = f"x{at}"
    other = [f"w{rnd.randrange(5000)}" for _ in range(3000)]
    texts = [" ".join(words) for words in (base, close, far, other)]
    apart = [(simhash.fingerprint(texts[0].encode()) ^ simhash.fingerprint(t.encode())).bit_count() for t in texts]
    assert 0 <= apart[1] <= 2 < min(apart[2:])
    docs = frame(spark, list(enumerate(texts)))
    kept = lambda: sorted(r.doc_id for r in shingles.one_of_each(docs, similarity=0.5).collect())
    assert kept() == [0, 3]
    monkeypatch.setattr(shingles, "_links", lambda buckets, rows, width, similarity, edges, tested: edges)
    assert kept() == [0, 2, 3]


def test_near_dedup_verifies_what_simhash_links(spark):
    """A text that is mostly one repeated shingle has the fingerprint of another such text, and few shingles of it."""
    rows = [(k, "same " * 2000 + " ".join(f"{name}{i}" for i in range(30))) for k, name in enumerate("abc")]
    assert len({simhash.fingerprint(t.encode()) for _, t in rows}) == 1
    assert shingles.one_of_each(frame(spark, rows)).count() == 3
