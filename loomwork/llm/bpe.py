"""BPE encoding and decoding by a tokenization automaton.

The merge list is compiled once into a deterministic automaton over token labels by applying one merge gadget
per merge, in order. A gadget for ``(a, b) -> c`` takes the state ``q`` that every ``a`` arc enters, replaces it for ``a`` by
a copy of ``q`` without the ``b`` arc, and adds a ``c`` arc, wherever there is an ``a`` arc, to the state that ``b``
enters. All arcs of one label enter one state, so a state is a dated list of cuts on top of the state it was copied
from, and a label's arcs are those of its left part on the date it was added: the whole table takes space in
proportion to the vocabulary. A token sequence is accepted if and only if it is the BPE encoding of its bytes.

A word is encoded by walking its prefixes: each has exactly one last token whose arc leaves the state of the prefix
before it. Decoding emits the labels of the arcs.

Nulls: a null text is an empty one, with no ids and the decoded text ''. Texts may be of any length; a word of any
length costs time in proportion to it. Repeated rows, null ids and further columns don't matter.
"""

from __future__ import annotations

import hashlib
import json
import re
import unicodedata
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from loomwork.llm._common import Memo, in_arrow, renamed, text_bytes

#: Answers on pairs of state and label that a worker keeps.
KNOWN = 400_000
#: What the normalizer takes for white space.
SPACE = regex.compile(r"\p{White_Space}+")
#: What the pre-tokenizer takes for a word. ``pieces`` relies on it, so another file's pattern is not accepted.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def byte_alphabet() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies: itself where printable, else
    the next of the characters from 256 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(rest)) for b in range(256)]


#: Between a letter and ASCII punctuation or a digit, the apostrophe excepted.
BOUNDARY = re.compile(rb"(?:(?<=[a-z])|(?<=\xc3[\x80-\x96\x98-\xb6\xb8-\xbf]))(?=[!-&(-@\[-`{-~])")


def whole_words(text: bytes) -> bool:
    """Whether a text may hold a special token's name or a combining mark."""
    return b"<|" in text or b"\xcc" in text or b"\xcd" in text


def pieces(text: bytes) -> list[bytes]:
    """A text cut where no token and no composition of characters can reach across: at ASCII white space and, with A-Z
    lower-cased as the vocabulary's normalizer does, at BOUNDARY. Texts of ``whole_words`` are cut at white space alone."""
    if whole_words(text):
        return text.split()
    return BOUNDARY.sub(b" ", text.lower()).split()


class MergeAutomaton:
    """The automaton. The state that label ``a`` enters is named ``a``; gadgets are kept as dated cuts."""

    def __init__(self, vocab: dict[str, int], merges: list[tuple[str, str]], end: str):
        self.end = end
        self.ids = vocab
        made = {a + b for a, b in merges}
        forever = len(merges) + 1
        #: label -> the labels beside whose arcs its own run, itself first, and until which gadget each could be cut
        self.beside: dict[str, tuple[tuple[str, int], ...]] = {}
        #: state -> the cuts (arc taken away -> gadget) of the states it is copied from, and which gadgets count
        self.copied: dict[str, tuple[tuple[dict[str, int], int], ...]] = {}
        self.born = {label: 0 for label in vocab if label not in made}
        for label in self.born:
            self.beside[label], self.copied[label] = ((label, forever),), (({}, forever),)
        for when, (a, b) in enumerate(merges, 1):
            if a in self.born and b in self.born and a + b not in self.born and self.arc(a, b):
                self._gadget(a, b, when, forever)
        #: up to three characters -> lengths of the labels within a word that begin so, longest first
        self.lengths: dict[str, tuple[int, ...]] = {}
        inner = [label for label in self.born if not end or not label.endswith(end)]
        found: dict[str, set[int]] = defaultdict(set)
        for label in inner:
            found[label[:3]].add(len(label))
        for head in list(found):
            for k in range(1, len(head)):
                found[head] |= {k} & found.get(head[:k], set())
        self.lengths = {head: tuple(sorted(each, reverse=True)) for head, each in found.items()}
        self.known: dict[str, dict[str, bool]] = defaultdict(dict)
        self.asked = 0

    def _gadget(self, a: str, b: str, when: int, forever: int) -> None:
        c = a + b
        self.copied[a][0][0][b] = self.born[c] = when
        self.beside[c] = ((c, forever), (a, when), *self.beside[a][1:])
        # its state is that of b as it was before this gadget
        self.copied[c] = (({}, forever), (self.copied[b][0][0], when - 1), *self.copied[b][1:])

    def arc(self, state: str, label: str) -> bool:
        """Whether the label may follow in the state: no cut of the state, or of those it was copied from before the
        copy was made, takes away the label, or one that its arcs ran beside when they were added."""
        beside = self.beside[label]
        for cuts, copied in self.copied[state]:
            if cuts:
                for arc, added in beside:
                    when = cuts.get(arc)
                    if when is not None and when <= copied and when <= added:
                        return False
        return True

    def follows(self, state: str, label: str) -> bool:
        """``arc``, with the answer kept for ``walk``."""
        if self.asked >= KNOWN:
            self.known.clear()
            self.asked = 0
        self.asked += 1
        found = self.known[state][label] = not state or self.arc(state, label)
        return found

    def walk(self, word: str) -> list[str]:
        """The labels on the accepted path that spells the word: at each place the longest label that may follow,
        with a step back where a path ends. Places that lead nowhere are left once, so time is in proportion."""
        born, end, lengths, n = self.born, self.end, self.lengths, len(word)
        path: list[str] = []
        dead: set[int] = set()
        at, last, limit = 0, "", n + 1
        while at < n:
            known = self.known[last]
            label = word[at:] + end
            if n - at < limit and label in born:
                ok = known.get(label)
                if ok or ok is None and self.follows(last, label):
                    path.append(label)
                    return path
            head = word[at : at + 3]
            while head not in lengths:
                head = head[:-1]
            for length in lengths[head]:
                till = at + length
                if length < limit and till < n and till not in dead:
                    label = word[at:till]
                    if label in born:
                        ok = known.get(label)
                        if ok or ok is None and self.follows(last, label):
                            path.append(label)
                            at, last, limit = till, label, n + 1
                            break
            else:  # nothing follows here: take back the last label and try a shorter one
                dead.add(at)
                limit = len(path.pop())
                at -= limit
                last = path[-1] if path else ""
        return path


def read_spec(path: str) -> dict:
    """A vocabulary file, if its texts are normalized and split as this module does it; another raises ValueError."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    model, normalizer, splitter = spec["model"], spec.get("normalizer") or {}, spec.get("pre_tokenizer") or {}
    steps = [(n.get("type"), n.get("pattern"), n.get("content")) for n in normalizer.get("normalizers", ())]
    parts = splitter.get("pretokenizers", ())
    sound = {
        "normalizer": steps == [("NFC", None, None), ("Replace", {"Regex": r"\s+"}, " "), ("Lowercase", None, None)],
        "pre_tokenizer": [p.get("type") for p in parts] == ["Split", "ByteLevel"] and parts[0].get("invert") and parts[0].get("behavior") == "Removed" and parts[0].get("pattern") == {"Regex": WORDS} and not parts[1].get("add_prefix_space") and not parts[1].get("use_regex"),
        "model": model.get("type") == "BPE" and not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "byte_fallback", "ignore_merges")),
        "decoder": spec.get("decoder") is None,
        "added_tokens": all(t["special"] and t["content"].startswith("<|") and not (t["normalized"] or t["lstrip"] or t["rstrip"] or t["single_word"]) for t in spec.get("added_tokens", ())),
    }
    if not all(sound.values()):
        raise ValueError(f"{path}: not a file of the kind that this module encodes: {[k for k, ok in sound.items() if not ok]}")
    return spec


class Codec:
    """Encoder and decoder of one vocabulary file: normalization, pre-split and the automaton."""

    def __init__(self, path: str):
        spec = read_spec(path)
        model = spec["model"]
        merges = [tuple(m.split(" ") if isinstance(m, str) else m) for m in model["merges"]]
        end = model.get("end_of_word_suffix") or ""
        self.automaton = MergeAutomaton(model["vocab"], merges, end)
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        self.label = {i: t for t, i in model["vocab"].items()} | {i: t for t, i in self.special.items()}
        self.at_special = regex.compile("|".join(map(regex.escape, self.special))) if self.special else None
        self.words = regex.compile(WORDS)
        self.alphabet = byte_alphabet()
        self.memo = Memo(self.encode_piece)
        self.spoken = Memo(self.speak)

    def _word(self, word: str) -> list[int]:
        spelled = word if word.isascii() and word.isprintable() else "".join([self.alphabet[b] for b in word.encode()])
        return [self.automaton.ids[label] for label in self.automaton.walk(spelled)]

    def _plain(self, text: str) -> Iterator[int]:
        if text.isascii():
            text = text.lower()
        else:  # by character, so that a final sigma is like any other
            text = "".join(map(str.lower, unicodedata.normalize("NFC", text)))
        for part in SPACE.split(text):
            for word in self.words.findall(part):
                yield from self._word(word)

    def encode_piece(self, piece: bytes) -> list[int]:
        text, out, at = piece.decode("utf-8", "replace"), [], 0
        if text.isalpha() and text.isascii():
            return self._word(text.lower())
        for m in self.at_special.finditer(text) if self.at_special else ():
            out += self._plain(text[at : m.start()])
            out.append(self.special[m[0]])
            at = m.end()
        out += self._plain(text[at:])
        return out

    def speak(self, piece: bytes) -> tuple[int, str, str]:
        """A piece's number of ids, its ids and its labels as text."""
        ids = self.encode_piece(piece)
        return len(ids), " ".join(map(str, ids)), self.decode(ids)

    def encode(self, text: bytes) -> list[list[int]]:
        """The ids of each piece of the text."""
        memo = self.memo
        return [memo[piece] for piece in pieces(text)]

    def decode(self, ids: list[int]) -> str:
        """The arcs' labels; the file has no decoder, so one space stands between them."""
        return " ".join([self.label[i] for i in ids])


@lru_cache(maxsize=4)
def codec(path: str) -> Codec:
    """One per Python worker and file."""
    return Codec(path)


def encode(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids): every whole text as token ids."""
    kind = docs.schema[id_col].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(tokenizer)
        for batch in batches:
            ids = [[i for piece in c.encode(text) for i in piece] for text in text_bytes(batch["text"])]
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(ids, pa.list_(pa.int32()))], ["doc_id", "ids"])

    return in_arrow(renamed(docs, doc_id=id_col, text=text_col), work, f"doc_id {kind}, ids array<int>")


def decode(encoded: DataFrame, tokenizer: str) -> DataFrame:
    """(doc_id, text): the labels of (doc_id, ids); null ids give null."""
    kind = encoded.schema["doc_id"].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(tokenizer)
        for batch in batches:
            texts = [None if ids is None else c.decode(ids) for ids in batch["ids"].to_pylist()]
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(texts, pa.string())], ["doc_id", "text"])

    return in_arrow(encoded.select("doc_id", "ids"), work, f"doc_id {kind}, text string")


def round_trip(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", ids: bool = False) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256): encode and decode each whole text in one pass, without
    sending the ids through the JVM unless a column ``ids`` is asked for. A null text counts as empty: 0 tokens and the digests of ''."""
    kind = docs.schema[id_col].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(tokenizer)
        memo = c.spoken
        for batch in batches:
            n, ids_sha, text_sha, all_ids = [], [], [], []
            for text in text_bytes(batch["text"]):
                spoken = [x for p in pieces(text) if (x := memo[p])[0]]
                numbers = " ".join([x[1] for x in spoken])
                n.append(sum([x[0] for x in spoken]))
                ids_sha.append(hashlib.sha256(numbers.encode()).hexdigest())
                text_sha.append(hashlib.sha256(" ".join([x[2] for x in spoken]).encode()).hexdigest())
                if ids:
                    all_ids.append(np.array(numbers.split(), np.int32))
            cols = [batch["doc_id"], pa.array(n, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(text_sha, pa.string())]
            names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
            if ids:
                cols.append(pa.array(all_ids, pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(cols, names)

    schema = f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * ids
    return in_arrow(renamed(docs, doc_id=id_col, text=text_col), work, schema)
