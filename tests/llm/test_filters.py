"""Toxicity, decontamination, url filters and the archive."""

import base64
import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from loomwork.llm import decontaminate, toxicity, urls, warc


def words_of(text):
    return re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").encode().lower())


def hits(docs, items):
    windows = {}
    for key, text in items:
        words = words_of(text)
        if words and key is not None:
            for i in range(max(1, len(words) - 12)):
                windows.setdefault(tuple(words[i : i + 13]), set()).add(str(key))
    out = {}
    for key, text in docs:
        words = words_of(text)
        hit, found = [0] * len(words), set()
        for window, keys in windows.items():
            for i in range(len(words) - len(window) + 1):
                if tuple(words[i : i + len(window)]) == window:
                    hit[i : i + len(window)] = [1] * len(window)
                    found |= keys
        n = sum(hit)
        out[key] = (len(words), n, len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), n > 0 and 20 * n >= len(words))
    return out


@pytest.mark.parametrize("bound", [0, 500_000])
def test_decontamination(spark, bound):
    rnd = random.Random(2)
    word = lambda: rnd.choice(["Alpha", "beta", "gamma", "délta", "x1"])
    items = [(k, " ".join(word() for _ in range(rnd.choice([2, 12, 13, 14, 30])))) for k in range(8)] + [(50, None), (51, "!!"), (None, "beta beta"), (3, "zeta")]
    docs = [(k, ", ".join([word() for _ in range(40)] + (items[k % 8][1].upper().split() if k % 3 else []))) for k in range(40)] + [(100, None), (101, ""), (102, "zeta"), (103, "x " * 5000)]
    frame = spark.createDataFrame([(k, t, "a", 0) for k, t in docs], "doc_id long, text string, window string, at int")
    bench = spark.createDataFrame([(k, t, 1) for k, t in items], "item_id long, text string, doc_id int")
    got = decontaminate.judged(decontaminate.hits(frame, bench, broadcast_windows=bound)).collect()
    want = hits(docs, items)
    assert {r.doc_id: (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in got} == want
    kept = decontaminate.without_documents(frame, bench, broadcast_windows=bound)
    assert kept.columns == frame.columns
    assert {r.doc_id for r in kept.collect()} == {k for k, w in want.items() if not w[-1]}
    left = dict(decontaminate.without_spans(frame, bench).collect())
    assert all(len(words_of(left[k])) == want[k][0] - want[k][1] for k, _ in docs)


@pytest.mark.parametrize("bound", [0, 500_000])
def test_decontamination_keeps_columns_of_any_names(spark, bound):
    """The same rows and values on both sides of the broadcast bound."""
    item = " ".join(f"w{i}" for i in range(20))
    rows = [(1, item, "x"), (2, "clean text", "y"), (2, None, "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _row string").withColumns({"__row": F.lit("r"), "covers": F.lit(1)})
    kept = decontaminate.without_documents(docs, spark.createDataFrame([(1, item)], "item_id long, text string"), broadcast_windows=bound)
    assert kept.columns == docs.columns
    assert sorted(r["_row"] for r in kept.collect()) == ["y", "z"]


def test_decontamination_of_empty_tables(spark):
    docs, items = spark.createDataFrame([], "doc_id long, text string"), spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.hits(docs, items).count() == 0
    one = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    assert [r.n_hit for r in decontaminate.hits(one, items).collect()] == [0]


def test_toxicity(spark):
    rnd = random.Random(4)
    mild = [f"w{i}" for i in range(300)]
    rows = []
    for k in range(1200):
        words = [rnd.choice(mild) for _ in range(rnd.randint(5, 60))]
        bad = k % 4 == 0
        if bad:
            words.insert(rnd.randrange(len(words)), rnd.choice(["Vile!", "nasty", "rotten..."]))
        rows.append((k, " ".join(words), rnd.choice(["en", "fr"]), int(bad)))
    docs = spark.createDataFrame([(k, t, lang, 0.5) for k, t, lang, _ in rows], "doc_id long, text string, lang string, score double")
    labels = spark.createDataFrame([(k, y) for k, *_, y in rows] + [(None, 1), (3, None)], "doc_id long, toxic int")
    model = toxicity.train(docs, labels)
    got = {r.doc_id: r for r in toxicity.judged(docs, model).collect()}
    held = [k for k in got if got[k].held_out]
    assert 200 < len(held) < 400
    assert sum(got[k].predicted == rows[k][3] for k in held) >= 0.95 * len(held)
    kept = {r.doc_id for r in toxicity.without_toxic(docs, model).collect()}
    assert sum((k in kept) == (rows[k][3] == 0) for k in held) >= 0.95 * len(held)
    odd = spark.createDataFrame([(1, None), (2, ""), (2, "w1 " * 200_000), (None, "nasty " + "w2 " * 70_000)], "doc_id long, text string")
    scores = toxicity.score(odd, model).collect()
    assert len(scores) == 4 and all(0 <= r.score <= 1 for r in scores)
    assert toxicity.score(odd.limit(0), model).count() == 0


def test_toxicity_without_labels(spark):
    docs = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    model = toxicity.train(docs, spark.createDataFrame([], "doc_id long, toxic int"))
    assert [r.score for r in toxicity.score(docs, model).collect()] == [0.0]


def labelled_urls():
    return [(re.sub("^.*?://", "", u).split("/")[0], "/" + u.split("/", 3)[3].split("?")[0], y) for u, y in urls.LABELLED]


def test_url_model_on_held_out_urls():
    """Eight folds of the labelled table: each url is judged by a model that hasn't seen it."""
    rows, right, found, blocked = labelled_urls(), 0, 0, 0
    for fold in range(8):
        model = urls.train([r for i, r in enumerate(rows) if i % 8 != fold])
        held = rows[fold::8]
        said = model.score([h for h, *_ in held], [p for _, p, _ in held]) >= 0.5
        right += sum(bool(s) == bool(y) for s, (*_, y) in zip(said, held, strict=True))
        found += sum(bool(s) and bool(y) for s, (*_, y) in zip(said, held, strict=True))
        blocked += int(said.sum())
    print("accuracy", right / len(rows), "precision", found / blocked, "recall", found / sum(y for *_, y in rows))
    assert right >= 0.8 * len(rows)


def test_url_features_gram_by_gram():
    hosts, paths = ["a.com", "", "é.org", "x" * 3000], ["/p", "", "/a/a/a/a", "/q"]
    row, bucket = urls.features(hosts, paths)
    for i, (h, p) in enumerate(zip(hosts, paths, strict=True)):
        want = set()
        for part, text in ((1, h), (2, p)):
            data = b"^" + text.encode() + b"$"
            for n in urls.GRAMS:
                for at in range(len(data) - n + 1):
                    gram = int.from_bytes(bytes([4 * n + part]) + data[at : at + n], "big")
                    want.add((gram * urls.MIX) % (1 << 64) >> 64 - urls.BUCKET_BITS)
        assert sorted(bucket[row == i].tolist()) == sorted(want)


def test_urls_by_hand(spark):
    """Host, path, rule and verdict of every page, by plain string work."""
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet").select("page_id", "url")
    odd = [None, "", "://", "a://b", "HTTP://Ä.COM/en/?x", "http://a.com://b.net/es/", "http://x.net/fr/\n/#", "http://example.com/en", "http://.com/", "http://xnet/es/1"]
    pages = pages.unionByName(spark.createDataFrame([(-i, u) for i, u in enumerate(odd, 1)], "page_id long, url string"))
    got = {r.page_id: r for r in urls.judged(pages).collect()}
    seen = set()
    for page_id, url in pages.collect():
        _, there, rest = (url or "").partition("://")
        rest = rest if there else ""
        end = min([rest.index(c) for c in "/?#" if c in rest], default=len(rest))
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:end])
        path = re.split("[?#]", rest[end:], maxsplit=1)[0]
        fits = []
        for says, rule in urls.RULES:
            name, _, start = rule.partition("/")
            if (host == name or host.endswith("." + name)) and path.startswith("/" + start):
                fits.append((len(rule), rule, says))
        r = got[page_id]
        assert (r.host, r.path) == (host, path)
        assert r.rule == (max(fits)[1] if fits else None)
        assert r.verdict == (max(fits)[2] if fits else "block" if r.score >= 0.5 else "allow")
        seen.add((r.rule, r.verdict))
    assert len(seen) >= 6 and len(got) == pages.count()


def test_a_labelled_table_that_is_too_large_raises(spark, monkeypatch):
    monkeypatch.setattr(urls, "MAX_LABELLED", 2)
    table = spark.createDataFrame([(f"http://a/{i}", i % 2) for i in range(3)], "url string, label int")
    with pytest.raises(ValueError):
        urls.train_table(table)
    assert urls.train_table(table.limit(0)).score(["a"], [""]).tolist() == [0.5]


def test_urls(spark):
    cases = [
        ("http://WWW.Example.com/en/1", "www.example.com", "/en/1", "www.example.com/en/", "allow"),
        ("https://blog.example.com/en/1?x=/y#z", "blog.example.com", "/en/1", "example.com/en/", "block"),
        ("https://example.com/fr/", "example.com", "/fr/", "com/", "allow"),
        ("https://a.net/es/x", "a.net", "/es/x", "net/es/", "block"),
        ("https://a.com", "a.com", "", None, None),
        ("https://notexample.org/en/", "notexample.org", "/en/", None, None),
        ("x://com?q", "com", "", None, None),
        ("no scheme", "", "", None, None),
        (None, "", "", None, None),
        ("http://h/" + "p" * 50_000, "h", "/" + "p" * 50_000, None, None),
    ]
    pages = spark.createDataFrame([(i, c[0], "host", "rule") for i, c in enumerate(cases)], "page_id long, url string, host string, rule string")
    got = {r.page_id: r for r in urls.judged(pages).collect()}
    for i, (_, host, path, rule, verdict) in enumerate(cases):
        assert (got[i].host, got[i].path, got[i].rule) == (host, path, rule)
        assert got[i].verdict == verdict if verdict else got[i].verdict in ("allow", "block")
    model = urls.train(labelled_urls())
    assert np.diff(model.score(["library.example.org", "cheap-pills.example.org"], ["/en/catalogue", "/buy"]))[0] > 0.1
    assert urls.judged(pages.limit(0)).count() == 0


@pytest.mark.parametrize("least", [0, 3])
def test_archive(spark, least):
    rows = [(3, "http://a", "abc"), (1, "u\r\nX: y", "abc"), (2, None, None), (None, "z", "abc"), (5, "q", ""), (6, "é", "é"), (6, "é", "é"), (7, "long", "x" * 200_000)]
    pages = spark.createDataFrame([(*r, "d") for r in rows], "page_id long, url string, html string, digest string")
    archive = warc.write(pages, min_bytes=least)
    assert archive.payloads.count() == 4
    records = warc.read(archive).collect()
    assert len(records) == len(rows)
    first = {"abc": 1, "": 2, "é": 6, "x" * 200_000: 7}
    want = sorted(str((k, len((h or "").encode()), base64.b32encode(hashlib.sha1((h or "").encode()).digest()).decode(), again := "revisit" if k != first[h or ""] and len((h or "").encode()) >= least else "response", first[h or ""] if again == "revisit" else None)) for k, _, h in rows)
    assert sorted(str((r.page_id, r.payload_bytes, r.stored_digest, r.record_type, r.refers_to)) for r in records) == want
    assert all(r.payload_digest == r.stored_digest for r in records)
    blob = {r.page_id: bytes(r.record) for r in warc.record_bytes(warc.read(archive)).collect()}
    head, _, block = blob[1].partition(b"\r\n\r\n")
    assert head.startswith(b"WARC/1.1\r\nWARC-Type: response") and b"Content-Length: 3" in head and block == b"abc\r\n\r\n"
    assert warc.read(warc.write(pages.limit(0))).count() == 0


def test_archive_gives_back_urls_and_ids_as_they_were(spark):
    """Line separators of any kind can't enter a header as lines, and come back."""
    ends = ["\x85", "\u2028", "\u2029", "\r", "\n", "\r\n", "%0D", "%250A\r", ""]
    ids = ["", "a", "b>", "c%0A", "d\r\nWARC-Refers-To: <urn:page:a>", "e\u2028", "f\n", "g%", "h"]
    urls = [f"http://a/{end}WARC-Refers-To: <urn:page:77>" for end in ends]
    pages = spark.createDataFrame([(k, u, f"body of {k}") for k, u in zip(ids, urls, strict=True)] + [(None, None, "x")], "page_id string, url string, html string")
    records = warc.read(warc.write(pages), "string").collect()
    assert sorted((r.page_id or "-", r.url) for r in records) == sorted([*((k or "-", u) for k, u in zip(ids, urls, strict=True)), ("-", "")])
    assert {r.page_id for r in records} == {*ids, None} and all(r.refers_to is None and r.record_type == "response" for r in records)
    again = warc.read(warc.write(pages.unionByName(pages.selectExpr("concat('z', page_id) as page_id", "url", "html"))), "string").where("record_type = 'revisit'")
    assert {(r.page_id, r.refers_to) for r in again.collect()} == {("z" + k, k) for k in ids}


def test_archive_raises_on_a_false_payload(spark):
    archive = warc.write(spark.createDataFrame([(1, "u", "abc")], "page_id long, url string, html string"))
    bad = warc.Archive(archive.headers, archive.payloads.withColumn("payload", F.lit(b"abd")))
    with pytest.raises(Exception, match="doesn't match its digest"):
        warc.read(bad).collect()


@pytest.mark.parametrize("bound", [0, 500_000])
def test_contaminated_rows_are_judged_by_themselves(spark, bound):
    passage = " ".join(f"p{i}" for i in range(13))
    docs = spark.createDataFrame([(None, passage, 0), (None, "clean", 1), (7, passage, 2), (7, "clean", 3), (8, "clean too", 4)], "doc_id long, text string, at int")
    bench = spark.createDataFrame([(1, passage)], "item_id long, text string")
    assert sorted(r.at for r in decontaminate.without_documents(docs, bench, broadcast_windows=bound).collect()) == [1, 3, 4]


def test_toxicity_does_not_depend_on_the_piece(monkeypatch):
    rng = np.random.default_rng(3)
    model = toxicity.Model(toxicity.Network.fresh(rng), 0.5)
    model.table = [[t - 1 + (np.arange(len(t)) == toxicity.PAD)[:, None] for t in places] for places in model.table]  # padding alone is high
    texts = [rng.integers(0, toxicity.BUCKETS, n).astype(np.int32) for n in (0, 1, 9, 10, 11, 12, 13, 20, 31, 95)]
    whole = model.margins(texts)
    monkeypatch.setattr(toxicity, "PIECE", 10)
    assert np.allclose(model.margins(texts), whole, rtol=0, atol=1e-5)


def test_a_languages_threshold_weighs_both_classes_alike():
    """Toxic texts are rare: the best F1 lies where a quarter of them pass, which isn't where both classes are judged best."""
    scores = np.concatenate([np.full(75, 0.9), np.full(25, 0.2), np.full(1800, 0.01), np.full(100, 0.2)])
    labels = np.repeat([1.0, 0.0], [100, 1900])
    limit = toxicity._balanced(scores, labels)
    assert (scores[:100] >= limit).mean() == 1 and (scores[100:] < limit).mean() > 0.94
