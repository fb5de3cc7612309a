"""Token counts under a unigram vocabulary, without making the tokens."""

from __future__ import annotations

import re
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from lamina.llm.words import id_type, map_texts

SPACE, BREAK = "▁", "\n"
RUNS = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")
#: An unknown character scores so much less than the lowest piece, and counts as its bytes.
UNKNOWN_PENALTY = 10.0
#: Distinct strings between spaces whose counts a task keeps; it begins anew beyond.
CACHE = 1_000_000
CACHED_LENGTH = 64


class Counter:
    """The best segmentation's number of pieces by a Viterbi pass over all vocabulary matches.

    Of two segmentations of one score that end with different pieces, the one whose last piece begins first wins, as in
    a pass that goes from start to start and replaces an end's best only by a higher score. Scores are summed in double
    precision from the left.
    """

    def __init__(self, pieces: list[tuple[str, float]]):
        self.automaton = ahocorasick.Automaton()
        for piece, score in pieces:
            if piece:
                self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        self.unknown = min(score for _, score in pieces) - UNKNOWN_PENALTY
        self.breaks = not any(BREAK in p for p, _ in pieces)  # then no piece reaches over a line break
        self.inner = any(SPACE in p[1:].strip(SPACE) for p, _ in pieces)
        self.cache: dict[str, int] = {}

    def pieces(self, word: str) -> int:
        size = len(word)
        score, count = [0.0] * (size + 1), [0] * (size + 1)
        filled, single = 0, True

        def close(to: int) -> None:
            """Ends without a one-character piece get the unknown one."""
            nonlocal filled, single
            while filled < to:
                if not single:
                    s = score[filled - 1] + self.unknown
                    if best[0] is None or s > best[0]:
                        score[filled], count[filled] = s, count[filled - 1] + len(word[filled - 1].encode("utf-8", "surrogatepass"))
                    else:
                        score[filled], count[filled] = best
                elif filled:
                    score[filled], count[filled] = best
                filled += 1
                best[0], single = None, False

        best: list = [None, 0]
        for end, (n, own) in self.automaton.iter(word):  # for each end, the longest match comes first
            if end + 1 > filled:
                close(end + 1)
            s = score[end + 1 - n] + own
            if best[0] is None or s > best[0]:
                best[0], best[1] = s, count[end + 1 - n] + 1
            if n == 1:
                single = True
        close(size + 1)
        return count[size]

    def known(self, word: str) -> int:
        n = self.cache.get(word)
        if n is None:
            n = self.pieces(word)
            if len(word) <= CACHED_LENGTH:
                if len(self.cache) >= CACHE:
                    self.cache.clear()
                self.cache[word] = n
        return n

    def count(self, text: str | None) -> int:
        """Pieces of a whole text; a space stands before it, as before each word. An empty text has none."""
        if not text:
            return 0
        text = SPACE + text.replace(" ", SPACE)
        if self.inner:
            return self.pieces(text)
        total, known = 0, self.known
        parts = text.split(BREAK) if self.breaks else [text]
        total += len(parts) - 1  # one byte each
        for part in parts:
            if SPACE + SPACE in part:  # a run of spaces is matched with the word that it stands before
                total += sum(map(known, RUNS.findall(part)))
                continue
            first, *rest = part.split(SPACE)
            if first:
                total += known(first)
            for word in rest:
                total += known(SPACE + word)
        return total


@lru_cache(maxsize=2)
def vocabulary(path: str) -> tuple[tuple[str, float], ...]:
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=path)
    return tuple((model.id_to_piece(i), model.get_score(i)) for i in range(model.get_piece_size()))


@lru_cache(maxsize=2)
def counter(pieces: tuple[tuple[str, float], ...]) -> Counter:
    return Counter(list(pieces))


def token_counts(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_tokens long) for every row of docs; path: a file of pieces with scores, taken as a unigram vocabulary.

    A null or empty text has 0 tokens; ids may be null or repeat and come back as they are; other columns are not read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary(path))  # of fixed size, under 1 MB

    def make():
        c = counter(shared.value)

        def f(ids: pa.Array, texts: pa.Array) -> list:
            return [ids, np.array([c.count(t) for t in texts.to_pylist()], dtype=np.int64)]

        return f

    return map_texts(docs, [("doc_id", id_type(docs, id_col)), ("n_tokens", T.LongType())], make, id_col, text_col)
