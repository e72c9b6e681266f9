"""BPE, token-id files and the JPEG columns: equality with the library, and exact round trips."""

import hashlib
import os
import random
import zlib
from pathlib import Path

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from loomwork.llm import _common, bpe, jpeg, queries, token_files

PATH = public_tokenizers.path("word_bpe_49k.json")
KIND = "doc_id long, text string, ids string, part int"
TEXTS = [None, "", " \n", "Hello World's naïve <|endoftext|>x  <|ENDOFTEXT|> 123 á \x1c b", "hello!! 你好 😀", "a" * 3000, "don't they'll !'s", "Σς ΑΣ İ ß ǅ e\u0301 ;\u0338 J\u030c", "word,<|startoftext|>\u00a0next\u2028line", "the the the"]


def frame(spark, texts):
    return spark.createDataFrame([(k, t, "x", 1) for k, t in enumerate(texts)], KIND)


def noise(n=3000):
    rnd = random.Random(1)
    letters = "aeiothnsr'lld \n\t123!?é\u0301ΣςİßǅÀ你好<|endoftext|> \x1c\x85😀"
    return ["".join(rnd.choice(letters) for _ in range(rnd.randint(0, 60))) for _ in range(n)]


def test_automaton_equals_the_library():
    library, codec = Tokenizer.from_file(PATH), bpe.codec(PATH)
    texts = [t or "" for t in TEXTS] + noise() + ["ab" * k + "the" * k for k in range(60)] + ["a" * k for k in range(80)]
    for text in texts:
        ids = [i for piece in codec.encode(text.encode()) for i in piece]
        want = library.encode(text, add_special_tokens=False).ids
        assert ids == want, text
        assert codec.decode(ids) == library.decode(want, skip_special_tokens=False)


def test_encode_decode_and_round_trip(spark):
    library = Tokenizer.from_file(PATH)
    docs = frame(spark, TEXTS)
    encoded = bpe.encode(docs, PATH)
    decoded = dict(bpe.decode(encoded, PATH).collect())
    digests = {r.doc_id: r for r in bpe.round_trip(docs, PATH, ids=True).collect()}
    for k, text in enumerate(TEXTS):
        ids = library.encode(text or "", add_special_tokens=False).ids
        said = library.decode(ids, skip_special_tokens=False)
        assert decoded[k] == said
        assert digests[k].ids == ids and digests[k].n_tokens == len(ids)
        assert digests[k].ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert digests[k].decoded_sha256 == hashlib.sha256(said.encode()).hexdigest()
    assert bpe.round_trip(frame(spark, []), PATH).count() == 0


def test_token_files(spark, monkeypatch):
    library = Tokenizer.from_file(PATH)
    texts = [*TEXTS, *noise(200)]
    docs = frame(spark, texts)
    segments = token_files.write(docs, PATH)
    rows, digests = {r.doc_id: r for r in token_files.read(segments).collect()}, {r.doc_id: r for r in token_files.read_digests(segments).collect()}
    start = 0
    for k, text in enumerate(texts):
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 2]
        assert (rows[k].start, rows[k].n_tokens, rows[k].ids) == (start, len(ids), ids)
        assert digests[k].ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes())
        start += len(ids)
    assert token_files.read(token_files.write(frame(spark, []), PATH)).count() == 0


def test_files_of_another_kind_raise():
    for read in (bpe.codec, lambda path: token_files._encoder(path, 2)):
        with pytest.raises(ValueError, match="pre_tokenizer"):
            read(public_tokenizers.path("byte_bpe_50k.json"))


def test_pieces_of_many_texts_at_once():
    """numpy's cut against the pattern's, text by text, from the middle of an array too."""
    texts = [None if t is None else t.encode() for t in TEXTS + noise(500)] + [b"caf\xc3\xa9-x \xc3\x97, \xc3\xb7! \xc3\x89.", b"", b"a.", b".a", None]
    texts = [None if t is not None and bpe.whole_words(t) else t for t in texts]
    for some in (pa.array(texts), pa.array(texts)[7:], pa.array(texts)[:0], pa.array([b"", None])):
        pieces, count = token_files.cut_pieces(some)
        want = [bpe.pieces(t or b"") for t in some.to_pylist()]
        assert count.tolist() == [len(w) for w in want]
        assert pieces.to_pylist() == [p for w in want for p in w]


def test_rows_of_one_id_stand_in_the_order_of_their_texts(spark):
    docs = spark.createDataFrame([(1, "the cat"), (1, None), (1, "a"), (None, "of"), (1, "the cat")], "doc_id long, text string")
    rows = sorted(token_files.read(token_files.write(docs, PATH)).collect(), key=lambda r: r.start)
    library = Tokenizer.from_file(PATH)
    assert [(r.doc_id, r.ids) for r in rows] == [(k, [*library.encode(t, add_special_tokens=False).ids, 2]) for k, t in [(None, "of"), (1, ""), (1, "a"), (1, "the cat"), (1, "the cat")]]


def test_segments_are_closed_in_order(spark, monkeypatch):
    lengths, ids = [3, 1, 70_000, 2], np.arange(70_006) % 49_000
    ends, back = token_files.opened(token_files.image(lengths, ids, 2))
    assert ends.values().tolist() == np.cumsum(lengths).tolist() and (back == ids).all()


@pytest.mark.parametrize("n", [1, 2, 5, 100, 3000])
def test_elias_fano_selects(n):
    values = np.cumsum(np.random.default_rng(n).integers(0, 500, n))
    sequence = token_files.EliasFano.of(values)
    assert (sequence.values() == values).all()
    assert all(sequence.select(i) == values[i] for i in range(0, n, max(1, n // 50)))
    assert len(sequence.high) + len(sequence.low) <= n * (3 + np.log2(values[-1] / n + 1)) / 8 + 2 * token_files.STRIDE / 8


@pytest.mark.parametrize("n", [0, 1, 575, 576, 577, 5000, 23_040, 300_000])
def test_jpeg_is_lossless(n):
    data = os.urandom(n)
    media = jpeg.store(data)
    image = jpeg._parsed(media)
    parts = jpeg.coefficients_many([image])
    assert jpeg.payloads_of(parts, image[0]) == [jpeg.padded(data)]
    assert media[:2] == b"\xff\xd8" and media[-2:] == b"\xff\xd9" and jpeg.rgb(media).shape[2] == 3


def scans_bit_by_bit(media):
    """The coefficients by a plain reader of progressive scans: Huffman codes one bit at a time."""
    at, tables, out, blocks = 2, {}, {}, {}
    while media[at + 1] != 0xD9:
        marker, length = media[at + 1], int.from_bytes(media[at + 2 : at + 4], "big")
        body = media[at + 4 : at + 2 + length]
        at += 2 + length
        if marker == 0xC2:
            units = int.from_bytes(body[1:3], "big") // 16 * (int.from_bytes(body[3:5], "big") // 16)
            blocks = {1: 4 * units, 2: units, 3: units}
            out = {c: [[0] * 64 for _ in range(n)] for c, n in blocks.items()}
        elif marker == 0xC4:
            code, table, k = 0, {}, 17
            for size in range(1, 17):
                for _ in range(body[size]):
                    table[size, code] = body[k]
                    code, k = code + 1, k + 1
                code *= 2
            tables[body[0]] = table
        elif marker == 0xDA:
            end = at
            while media[end] != 0xFF or media[end + 1] == 0:
                end += 1
            bits = iter("".join(f"{b:08b}" for b in media[at:end].replace(b"\xff\x00", b"\xff")))
            at = end
            take = lambda n: int("0" + "".join(next(bits) for _ in range(n)), 2)  # noqa: B023, E731

            def symbol(table):
                size = code = 0
                while (size, code) not in table:
                    size, code = size + 1, 2 * code + take(1)  # noqa: B023
                return table[size, code]

            if body[0] == 3:
                assert all(symbol(tables[0]) == 0 for _ in range(sum(blocks.values())))
                continue
            component, which, first, last, high, low = body[1], body[2] & 15, body[3], body[4], body[5] >> 4, body[5] & 15
            run = 0
            for block in out[component]:
                k = first
                if not high:
                    while k <= last:
                        s = symbol(tables[0x10 | which])
                        k += s >> 4
                        value = take(s & 15)
                        block[k] = (value if value >> (s & 15) - 1 else value - (1 << (s & 15)) + 1) << low
                        k += 1
                else:
                    if not run:
                        s = symbol(tables[0x10 | which])
                        run = (1 << (s >> 4)) + take(s >> 4)
                    for k in range(first, last + 1):
                        if block[k]:
                            block[k] |= take(1) << low
                    run -= 1
    return out


def test_jpeg_scans_read_bit_by_bit():
    media = jpeg.store(bytes(range(256)) * 20)
    image = jpeg._parsed(media)
    fast, slow = jpeg.coefficients_many([image]), scans_bit_by_bit(media)
    for part, c in zip(fast, (1, 2, 3), strict=True):
        assert part[0].tolist() == slow[c]


def test_jpeg_columns(spark):
    texts = [*TEXTS, "x" * 700, "the the the"]
    docs = frame(spark, texts)
    stored = jpeg.stored(docs)
    rows = {r.doc_id: r for r in jpeg.described(stored).collect()}
    for k, text in enumerate(texts):
        data = (text or "").encode()
        payload = jpeg.padded(data)
        r = rows[k]
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) == (len(data), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-32:]))
    assert rows[9].feature == rows[len(texts) - 1].feature and rows[0].feature == rows[1].feature
    pixels = {r.doc_id: r for r in jpeg.tensors(stored).collect()}
    assert all(len(r.rgb) == r.height * r.width * 3 for r in pixels.values())
    assert jpeg.described(jpeg.stored(frame(spark, []))).count() == 0


def test_documents_by_position(spark):
    segments = token_files.write(frame(spark, [*TEXTS, *noise(60)]), PATH)
    rows = {r.doc_id: r.ids for r in token_files.read(segments).collect()}
    for s in segments.collect():
        for at in (0, len(s.doc_ids) // 2, len(s.doc_ids) - 1):
            assert token_files.document(bytes(s.image), at).tolist() == rows[s.doc_ids[at]]
        with pytest.raises(IndexError):
            token_files.document(bytes(s.image), len(s.doc_ids))


def test_media_are_stored_before_they_are_read(spark):
    sf_dir = "/root/testdata/sf0.001"
    folder = Path(_common.shared_folder(spark).removeprefix("file:"))
    old = set(folder.glob("media-*"))
    got = {r.doc_id: r.media_sha256 for r in queries.op10_jpeg(spark, sf_dir).collect()}
    (path,) = set(folder.glob("media-*")) - old
    stored = spark.read.parquet(str(path)).collect()
    assert {r.doc_id: hashlib.sha256(r.media).hexdigest() for r in stored} == got
