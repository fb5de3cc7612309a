"""BPE encoding and decoding with a tokenization automaton.

The automaton reads tokens. A path is accepted if and only if it is the tokenization that the merges give for the text
its labels spell. It starts with one state that loops over the single symbols; merge k, of u and v, then adds a gadget:
an arc labelled uv wherever u may be followed by v, to a state that goes on as the one after v did, and the arc v is
taken away from the state after u. One state stands for each last token, so the machine is deterministic, and a state
holds its arcs as what it inherited at birth less what was taken away: the transition table fills in as it is used.
Every prefix of an accepted path is accepted, so a word is encoded in one pass over the vocabulary's matches in it.
"""

from __future__ import annotations

import hashlib
import json
import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache
from pathlib import Path

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer as LibraryTokenizer

from lamina.llm.words import id_type, map_texts

CONTROLS = re.compile("[\x1c-\x1f]")
START = -1
_ALWAYS = 1 << 60
#: Entries of the transition table that a task keeps.
ARCS = 400_000
#: Distinct words whose tokens a task keeps, in each of two generations.
WORDS = 120_000
#: Longer ones, in characters, are not kept.
CACHED_LENGTH = 64
#: Characters whose class and case no version of Unicode since the tokenizer's has changed. Others are classed by the library.
SETTLED = re.compile("[\x00-\u052f]*")
#: Where the normalizer sees white space: Unicode's property White_Space, which str.split() exceeds by \x1c-\x1f.
SPACE = re.compile("[\t-\r \x85\xa0  -     　]+")


class Automaton:
    """Merges compiled one after the other. Tokens are numbers; pairs come in order of priority."""

    def __init__(self, symbols: int, pairs: list[tuple[int, int]]):
        self.symbols = symbols
        self.left = [0] * symbols + [u for u, _ in pairs]
        self.right = [0] * symbols + [v for _, v in pairs]
        self.rank = {pair: k for k, pair in enumerate(pairs)}
        self.arcs: dict[tuple[int, int], bool] = {}
        self.alive = [True] * symbols
        for k, (u, v) in enumerate(pairs):  # a gadget for a pair that never meets leaves a state without ways in
            self.alive.append(self.alive[u] and self.alive[v] and self._follows(u, v, k))

    def _follows(self, a: int, b: int, time: int) -> bool:
        """Whether b could follow a just before merge number time."""
        while True:
            if self.rank.get((a, b), _ALWAYS) < time:
                return False
            born_a, born_b = a - self.symbols, b - self.symbols
            if born_a < 0 and born_b < 0:
                return True
            if born_b > born_a:  # the arc b came to the states that had an arc for b's first half, after the removal
                time, b = born_b + 1, self.left[b]
            else:  # the state after a began with the arcs of the state after a's second half, before the removal
                time, b = born_a, self.left[b] if a == b else b
                a = self.right[a]

    def arc(self, state: int, token: int) -> bool:
        """Whether the table has a transition from the state after one token over another."""
        if state == START:
            return self.alive[token]
        known = self.arcs.get((state, token))
        if known is None:
            if len(self.arcs) >= ARCS:
                self.arcs.clear()
            known = self.arcs[state, token] = self.alive[token] and self._follows(state, token, _ALWAYS)
        return known


class Kept:
    """What was used lately: when a generation is full it becomes the old one, and what is used of that moves on."""

    def __init__(self, size: int):
        self.size, self.new, self.old = size, {}, {}

    def put(self, key: str, value: tuple) -> None:
        if len(self.new) >= self.size:
            self.new, self.old = {}, self.new
        self.new[key] = value

    def get(self, key: str) -> tuple | None:
        got = self.new.get(key)
        if got is None and (got := self.old.get(key)) is not None:
            self.put(key, got)
        return got


class Tokenizer:
    """What a tokenizers file of this kind says: NFC, white space, lower case, a split, bytes as symbols, word ends."""

    def __init__(self, path: str):
        spec = json.loads(Path(path).read_text(encoding="utf-8"))
        model, vocab = spec["model"], spec["model"]["vocab"]
        self.suffix = model["end_of_word_suffix"]
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        made = {u + v for u, v in merges}
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        base = [t for t in vocab if t not in made and t not in special]
        number = {t: n for n, t in enumerate([*base, *(u + v for u, v in merges)])}
        self.automaton = Automaton(len(base), [(number[u], number[v]) for u, v in merges])
        self.labels = {n: t for t, n in number.items()}
        self.id = {number[t]: i for t, i in vocab.items() if t in number}
        self.label_of_id = {i: t for t, i in {**vocab, **special}.items()}
        end = "\x00"  # stands for the suffix; byte symbols are printable
        self.token = {(t[: -len(self.suffix)] + end if t.endswith(self.suffix) else t): n for t, n in number.items() if self.automaton.alive[n]}
        self.end = end
        self.matches = ahocorasick.Automaton()
        for t, n in self.token.items():
            self.matches.add_word(t, (len(t), n))
        self.matches.make_automaton()
        self.special = special
        self.specials = re.compile("|".join(map(re.escape, sorted(special, key=len, reverse=True)))) if special else None
        self.split = regex.compile(spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"])
        self.bytes = byte_symbols()
        self.unbyte = {c: b for b, c in enumerate(self.bytes)}
        bare = spec | {"model": model | {"vocab": {}, "merges": []}, "added_tokens": []}
        self.library = LibraryTokenizer.from_str(json.dumps(bare))  # its normalizer and its split only
        self.id_text = {n: str(i) for n, i in self.id.items()}
        self.words = Kept(WORDS)

    def path(self, word: str) -> list[int]:
        """The accepted path whose labels spell the word (symbols, with the end mark).

        Every prefix has one accepted path at most, as the merges give it one tokenization, so one state stands at each
        place: the first of the tokens ending there that has a transition from the state where it begins.
        """
        known, arc, size = self.automaton.arcs.get, self.automaton.arc, len(word)
        state: list[int | None] = [START] + [None] * size
        back = [0] * (size + 1)
        for end, (n, t) in self.matches.iter(word):
            end += 1
            if state[end] is None:
                before = state[end - n]
                if before is not None and (known((before, t)) or arc(before, t)):
                    state[end], back[end] = t, end - n
        path = []
        while size:
            path.append(state[size])
            size = back[size]
        path.reverse()
        return path

    def word(self, word: str) -> tuple[int, str, str]:
        """The number of tokens of a word as the split gives it, their ids and their labels, each joined by a space."""
        path = self.path("".join([self.bytes[b] for b in word.encode()]) + self.end)
        got = (len(path), " ".join([self.id_text[t] for t in path]), " ".join([self.labels[t] for t in path]))
        if len(word) <= CACHED_LENGTH:
            self.words.put(word, got)
        return got

    def piece(self, raw: str) -> list[tuple[int, str, str]]:
        """The same of each word of a text without white space and special tokens."""
        known, word = self.words.get, self.word
        if not SETTLED.fullmatch(raw):
            unbyte = self.unbyte
            split = self.library.pre_tokenizer.pre_tokenize_str(self.library.normalizer.normalize_str(raw))
            return [word(bytes([unbyte[c] for c in w]).decode("utf-8")) for w, _ in split]
        text = raw.lower() if raw.isascii() else unicodedata.normalize("NFC", raw).replace("Σ", "σ").lower()  # each character by itself
        if text.isalpha():
            return [known(text) or word(text)]
        words = [text[:-1], text[-1]] if text[-1] in ".,;!?" and text[:-1].isalpha() else self.split.findall(text)
        return [known(w) or word(w) for w in words]

    def encode(self, text: str | None) -> tuple[int, str, str]:
        """Of a whole text: how many tokens, the ids joined by a space, and the decoded text."""
        found: list[tuple[int, str, str]] = []

        def plain(part: str) -> None:
            lately, piece = self.words.new.get, self.piece  # what the split gives for a word is the word
            for w in part.split() if not CONTROLS.search(part) else [w for w in SPACE.split(part) if w]:
                got = lately(w)
                if got is not None:
                    found.append(got)
                else:
                    found.extend(piece(w))

        text, at = text or "", 0
        if self.specials and "<|" in text:
            for m in self.specials.finditer(text):
                plain(text[at : m.start()])
                found.append((1, str(self.special[m[0]]), m[0]))
                at = m.end()
        plain(text[at:])
        return sum([f[0] for f in found]), " ".join([f[1] for f in found]), " ".join([f[2] for f in found])

    def decode(self, ids: list[int]) -> str:
        """The labels of the arcs, joined by a space, as the file names no decoder."""
        return " ".join(self.label_of_id[i] for i in ids)


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte: itself where it prints, else one from 256 on, in order."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return [chr(b) if b in shown else chr(256 + hidden.index(b)) for b in range(256)]


@lru_cache(maxsize=2)
def tokenizer(path: str) -> Tokenizer:
    return Tokenizer(path)


def _shared(docs: DataFrame, path: str):
    """The compiled automaton, sent to each executor once (a vocabulary of fixed size, some MB)."""
    return docs.sparkSession.sparkContext.broadcast(tokenizer(path))


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_tokens long, token_ids array<int>, decoded string) for every row of docs; path: the tokenizer's file.

    Whole texts are encoded as the file says, without special tokens added; strings of special tokens in a text become
    those tokens. decoded: the ids decoded again. A null or empty text has no tokens and decodes to an empty string; ids
    may be null or repeat and come back as they are; other columns are not read.
    """
    shared = _shared(docs, path)

    def make():
        t = shared.value

        def f(ids: pa.Array, texts: pa.Array) -> list:
            rows = [t.encode(x) for x in texts.to_pylist()]
            counts = np.array([r[0] for r in rows], dtype=np.int64)
            flat = np.fromstring(" ".join(r[1] for r in rows if r[0]), dtype=np.int32, sep=" ")
            tokens = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(counts))).astype(np.int32)), pa.array(flat))
            return [ids, counts, tokens, pa.array([r[2] for r in rows], pa.string())]

        return f

    fields = [("doc_id", id_type(docs, id_col)), ("n_tokens", T.LongType()), ("token_ids", T.ArrayType(T.IntegerType())), ("decoded", T.StringType())]
    return map_texts(docs, fields, make, id_col, text_col)


def digests(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256): as encode(), with the ids and the decoded text as digests only."""
    shared = _shared(docs, path)

    def make():
        t, digest = shared.value, lambda s: hashlib.sha256(s.encode("utf-8", "surrogatepass")).hexdigest()

        def f(ids: pa.Array, texts: pa.Array) -> list:
            rows = [t.encode(x) for x in texts.to_pylist()]
            return [ids, np.array([r[0] for r in rows], dtype=np.int64), pa.array([digest(r[1]) for r in rows]), pa.array([digest(r[2]) for r in rows])]

        return f

    fields = [("doc_id", id_type(docs, id_col)), ("n_tokens", T.LongType()), ("ids_sha256", T.StringType()), ("decoded_sha256", T.StringType())]
    return map_texts(docs, fields, make, id_col, text_col)


def decode(tokens: DataFrame, path: str, ids_col: str = "token_ids", out: str = "decoded") -> DataFrame:
    """tokens with a column of the text that each row's ids decode to; null for null, and empty for no ids.

    An id that the vocabulary lacks, or a null one, has no label and is left out, as the library does.
    """
    shared = _shared(tokens, path)

    def run(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        label = shared.value.label_of_id
        for ids in columns:
            yield pa.array([None if row is None else " ".join(label[i] for i in row if i in label) for row in ids.to_pylist()], pa.string())

    return tokens.withColumn(out, F.arrow_udf(run, "string")(F.col(ids_col)))
