"""The pipeline's stages keep the documents' columns and take effect one after another."""

import hashlib
import random
import re
import zlib
from collections import Counter

import corpus_pipeline
import numpy as np
import pytest
from loomwork.llm import queries, toxicity
from test_dedup import cut_lines
from test_filters import hits
from tokenizers import Tokenizer


def test_pipeline(spark):
    sf_dir = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "line_dedup", "near_dedup", "decontamination", "bpe"]
    columns, rows = docs.columns, [docs.count()]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.written(stage(spark, docs, sf_dir), "stage")
        assert docs.columns == columns
        rows.append(docs.count())
    assert rows == sorted(rows, reverse=True) and rows[-1] > 0.5 * rows[0]
    out = corpus_pipeline.run(spark, sf_dir)
    assert out.count() == rows[-1] and "ids" in out.columns


def test_every_operator_has_a_query():
    assert sorted(int(name[2:].split("_")[0]) for name in queries.queries()) == list(range(1, 14))


def shingles_of(text):
    words = (text or "").encode().lower().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def test_near_dedup_keeps_one_of_each_group_of_similar_documents(spark):
    """Against brute force: five-word shingles, 0.8 or more, whatever the ids."""
    rnd = random.Random(8)
    vocabulary = [f"w{i}" for i in range(2000)]
    rows = [(None, "nobody has this text but one row"), (7000, None), (7001, " \t"), (7002, "one"), (7003, "one"), (7004, "two words"), (7002, "another text under an id in use")]
    for k in range(40):
        base = [rnd.choice(vocabulary) for _ in range(rnd.choice((60, 300)))]
        for copy in range(4):
            words = list(base)
            for at in rnd.sample(range(len(words)), rnd.randint(0, len(words) // 40)):
                words[at] = rnd.choice(vocabulary)
            rows.append((None if k == 3 else 100 * k + copy, " ".join(words)))
    sets = [shingles_of(t) for _, t in rows]
    group, near = list(range(len(rows))), 0
    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if 5 * len(a & b) >= 4 * len(a | b):
                near += a != b
                group = [group[j] if g == group[i] else g for g in group]
    assert near > 60
    want = {}
    for at, (k, _) in enumerate(rows):
        want[group[at]] = min(want.get(group[at], (True, 0, at)), (k is None, k or 0, at))
    docs = spark.createDataFrame([(k, t, at) for at, (k, t) in enumerate(rows)], "doc_id long, text string, at int").coalesce(1)
    got = corpus_pipeline.dedup_documents(spark, docs, "").collect()
    named = lambda ats: sorted((rows[at][0] is None, rows[at][0] or 0, group[at]) for at in ats)
    assert named(r["at"] for r in got) == named(at for _, _, at in want.values())


def plain_score(net, model, text):
    """The network along one text, word by word and filter by filter."""
    ids = [zlib.crc32(w) & (toxicity.BUCKETS - 1) for w in re.findall(rb"[0-9a-z\x80-\xff]+", (text or "").encode().lower())]
    padded = [net.embedding[i] for i in (ids or [toxicity.PAD])] + [net.embedding[toxicity.PAD]] * (toxicity.WIDTHS[-1] - 1)
    out, z = 0, net.out_bias
    for filters, bias in zip(net.filters, net.bias, strict=True):
        for f in range(toxicity.FILTERS):
            each = [sum(float(padded[at + k] @ filters[k][:, f]) for k in range(len(filters))) for at in range(max(len(ids), 1))]
            z += max(max(each) + bias[f], 0) * net.out[out]
            out += 1
    return 1 / (1 + np.exp(-np.clip(z * model.scale + model.shift, -50, 50)))


def fixture(spark, folder):
    """(doc_id, text, lang, n_chars, fp) with toxic words, shared lines, copies, benchmark passages and odd rows."""
    rnd = random.Random(11)
    mild = [f"w{i}" for i in range(900)]
    passages = [[rnd.choice(mild) for _ in range(30)] for _ in range(6)]
    common = [" ".join(rnd.choice(mild) for _ in range(12)) for _ in range(4)]
    rows = []
    for k in range(150):
        lines = [" ".join(rnd.choice(mild) for _ in range(rnd.randint(15, 40))) for _ in range(rnd.randint(2, 5))]
        if k % 4 == 0:
            lines[0] += " " + rnd.choice(["Vile!", "nasty", "rotten..."])
        if k % 5 == 1:
            lines.insert(1, rnd.choice(common))
        if k % 7 == 2:
            lines.append(" ".join(rnd.choice(passages)).upper())
        rows.append((k, "\n".join(lines), rnd.choice(["en", "fr", None])))
        if k % 6 == 3:
            # joined to one line, so that line dedup leaves it to near-dedup
            rows.append((1000 + k, " ".join(lines).replace(lines[0].split()[0], "other", 1), "en"))
    rows += [(2000, None, "en"), (2001, "", None), (2002, " \t\n ", "fr"), (2003, "one", "en"), (2004, "one", "en"), (None, "a text without an id", "en")]
    rows += [rows[9], rows[9], (2005, "long " * 20_000, "en")]
    rows = [(k, t, lang, len(t or ""), f"f{at}") for at, (k, t, lang) in enumerate(rows)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, n_chars int, fp string")
    docs.write.parquet(f"{folder}/documents.parquet")
    labels = [(k, int(k % 4 == 0)) for k in range(150)] + [(None, 1), (3, None)]
    spark.createDataFrame(labels, "doc_id long, toxic int").write.parquet(f"{folder}/labels.parquet")
    items = [(k, " ".join(p)) for k, p in enumerate(passages)] + [(9, None), (10, "")]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return rows, items


def one_of_each(rows):
    sets = [shingles_of(r[1]) for r in rows]
    group = list(range(len(rows)))
    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if 5 * len(a & b) >= 4 * len(a | b):
                group = [group[j] if g == group[i] else g for g in group]
    first = {}
    for at, r in enumerate(rows):
        first[group[at]] = min(first.get(group[at], (True, 0, at)), (r[0] is None, r[0] or 0, at))
    return [rows[at] for *_, at in sorted(first.values(), key=lambda f: f[-1])]


def test_pipeline_by_brute_force(spark, tmp_path, monkeypatch):
    """Each stage's rows against a plain version of it, on what its predecessor kept."""
    rows, items = fixture(spark, tmp_path)
    nets, fit = [], toxicity._fit
    monkeypatch.setattr(toxicity, "_fit", lambda *a, **k: nets.append(fit(*a, **k)) or nets[-1])
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    model = toxicity.train(docs, spark.read.parquet(f"{tmp_path}/labels.parquet"))
    compared = lambda rs: Counter(tuple(r)[:4] for r in rs)

    def stage(at, docs):
        out = corpus_pipeline.written(corpus_pipeline.STAGES[at][1](spark, docs, str(tmp_path)), "stage")
        return out, out.collect()

    scores = [plain_score(nets[0], model, r[1]) for r in rows]
    apart = min(abs(s - model.thresholds.get(r[2], toxicity.THRESHOLD)) for s, r in zip(scores, rows, strict=True))
    assert apart > 1e-5
    want = [r for s, r in zip(scores, rows, strict=True) if s < model.thresholds.get(r[2], toxicity.THRESHOLD)]
    docs, got = stage(0, docs)
    assert compared(got) == compared(want) and len(rows) * 0.5 < len(want) < len(rows) - 20

    cut = cut_lines([(k, t) for k, t in dict.fromkeys((r[0], r[1]) for r in want)])
    before, want = want, [(k, cut[k, t], lang, None if t is None else len(cut[k, t]), fp) for k, t, lang, _, fp in want]
    docs, got = stage(1, docs)
    assert compared(got) == compared(want) and compared(want) != compared(before)

    before, want = want, one_of_each(want)
    docs, got = stage(2, docs)
    assert compared(got) == compared(want) and len(want) < len(before) - 3

    found = [hits([(0, r[1])], items)[0][-1] for r in want]
    before, want = want, [r for r, bad in zip(want, found, strict=True) if not bad]
    docs, got = stage(3, docs)
    assert compared(got) == compared(want) and len(want) < len(before) - 3

    library = Tokenizer.from_file(queries.TOKENIZER)
    ids = [library.encode(r[1] or "", add_special_tokens=False).ids for r in want]
    digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
    final = Counter((r[0], len(i), digest(" ".join(map(str, i))), digest(library.decode(i, skip_special_tokens=False))) for r, i in zip(want, ids, strict=True))
    shown = lambda rs: Counter((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in rs)
    assert shown(stage(4, docs)[1]) == final
    assert shown(corpus_pipeline.run(spark, str(tmp_path)).collect()) == final


@pytest.mark.parametrize("at", range(5))
def test_stages_of_empty_tables(spark, tmp_path, at):
    """No documents give no rows; documents without labels and benchmark stay."""
    schema = "doc_id long, text string, lang string, n_chars int, fp string"
    spark.createDataFrame([], "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    name, stage = corpus_pipeline.STAGES[at]
    assert stage(spark, spark.createDataFrame([], schema), str(tmp_path)).count() == 0
    rows = [(1, "some text of six plain words", "en", 28, "x"), (2, None, None, None, None), (None, "", "fr", 0, "z")]
    assert stage(spark, spark.createDataFrame(rows, schema), str(tmp_path)).count() == len(rows) - (name == "near_dedup")
