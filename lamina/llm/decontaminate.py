"""Benchmark items in documents: SimHash of item-sized windows, multi-index Hamming blocks, exact verification."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lamina.llm.words import find_words, grams, id_type, map_texts, mix, text_udf, two_columns

WIDTH = 5
SIMILARITY = 0.8
#: Two texts of similarity 0.8 differ in about 10 of 64 bits on average; 22 is over four standard deviations more.
RADIUS = 22
BLOCKS = 8
#: Bytes of benchmark text that are looked for in one pass over the documents.
PASS_BYTES = 4 << 20
#: Windows that are fingerprinted at a time.
WINDOWS = 16384
#: Items of one size that share a word of the block tables.
GROUP = 64


#: Against rounding of products of the similarity and sizes; it only adds candidates.
_SLACK = 1e-9


def simhash_rows(sums: np.ndarray) -> np.ndarray:
    """Fingerprints of rows of 64 sums of +1 and -1."""
    return np.packbits(sums > 0, axis=1, bitorder="little").view("<u8").ravel()


def signs(hashes: np.ndarray) -> np.ndarray:
    return np.unpackbits(np.ascontiguousarray(hashes).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(np.int32) * 2 - 1


def weighted_similarity(a: np.ndarray, b: np.ndarray) -> float:
    """Of two bags of shingles: the sum of the smaller counts over the sum of the larger."""
    x, n = np.unique(a, return_counts=True)
    y, m = np.unique(b, return_counts=True)
    _, i, j = np.intersect1d(x, y, assume_unique=True, return_indices=True)
    both = int(np.minimum(n[i], m[j]).sum())
    return both / (len(a) + len(b) - both) if len(a) + len(b) - both else 0.0


class Balance:
    """For 64 bits at each of count places: how often the bit is set among the size shingles from the place on, less half the
    size, less 1. Number j of the planes has bit j of all 64 numbers, in two's complement; the last has their signs."""

    def __init__(self, shingles: np.ndarray, count: int, longest: int):
        self.count, self.size = count, 0
        #: runs[j]: planes of the sums of 2**j shingles from each place.
        self.runs = [[shingles[: count + longest]]]
        self.planes = [np.full(count, ~np.uint64(0)) for _ in range(longest.bit_length() + 1)]
        self.carry, self.spare = np.empty(count, np.uint64), np.empty(count, np.uint64)

    def _run(self, j: int) -> list[np.ndarray]:
        while len(self.runs) <= j:
            last, step = self.runs[-1], 1 << (len(self.runs) - 1)
            out, carry = [], None
            for x in last:
                a, b = x[:-step], x[step:]
                either = a ^ b
                out.append(either if carry is None else either ^ carry)
                carry = a & b if carry is None else a & b | either & carry
            self.runs.append([*out, carry])
        return self.runs[j]

    def _step(self, change: np.ndarray, up: bool, low: int = 0) -> None:
        """Adds or takes 1 << low where change has a bit."""
        carry, spare = self.carry, self.spare
        np.copyto(carry, change)
        for plane in self.planes[low:-1]:
            if up:
                np.bitwise_and(plane, carry, out=spare)
                np.bitwise_xor(plane, carry, out=plane)
            else:
                np.bitwise_xor(plane, carry, out=plane)
                np.bitwise_and(plane, carry, out=spare)
            carry, spare = spare, carry
        np.bitwise_xor(self.planes[-1], carry, out=self.planes[-1])

    def grow(self, size: int) -> np.ndarray:
        """Fingerprints of the windows of a size, not less than the last one: a bit is 1 where over half the shingles have it."""
        while self.size < size:
            gap, here = size - self.size, self.size
            if gap < 4:
                own, odd = self.runs[0][0][here : here + self.count], here % 2 == 1
                self._step(~own if odd else own, not odd)
                self.size += 1
                continue
            j = gap.bit_length() - 1
            for low, x in enumerate(self._run(j)):
                self._step(x[here : here + self.count], True, low)
            every, half = np.full(self.count, ~np.uint64(0)), (here + (1 << j)) // 2 - here // 2
            for low in range(half.bit_length()):
                if half >> low & 1:
                    self._step(every, False, low)
            self.size += 1 << j
        return ~self.planes[-1]


@dataclass
class SizeClass:
    """Items of one number of words, each a window of `size` shingles of `k` words."""

    words: int
    k: int
    items: list[int]
    shingles: list[np.ndarray]
    prints: np.ndarray
    #: For each group of items, block and value of the block, a bit for each item: whether the block of a similar window can
    #: have the value, and whether it is within RADIUS // BLOCKS of the item's.
    reach: np.ndarray
    near: np.ndarray
    #: Blocks that are looked up for all windows of a group of items before the rest are for those that are left.
    early: list[int]

    @property
    def size(self) -> int:
        return self.words - self.k + 1

    @classmethod
    def of(cls, words: int, k: int, items: list[int], shingles: list[np.ndarray], similarity: float, radius: int) -> "SizeClass":
        """A similar window has at most size * 2 * (1 - similarity) / (1 + similarity) shingles more and less than the item, each
        of which moves the sum of +1 and -1 of a bit by 1: a bit whose sum is beyond that can't flip."""
        sums = np.stack([signs(s).sum(axis=0) for s in shingles])
        prints = simhash_rows(sums)
        moved = int(2 * len(shingles[0]) * (1 - similarity) / (1 + similarity) + _SLACK)
        fixed = np.packbits((sums > moved) | (sums <= -moved), axis=1, bitorder="little")
        own, groups = prints.view(np.uint8).reshape(-1, BLOCKS), -(-len(items) // GROUP)
        reach, near = (np.zeros((groups, BLOCKS, 256), dtype=np.uint64) for _ in range(2))
        values = np.arange(256, dtype=np.uint8)
        for i in range(len(items)):
            changed, bit = values[None, :] ^ own[i][:, None], np.uint64(1 << i % GROUP)
            reach[i // GROUP][changed & fixed[i][:, None] == 0] |= bit
            near[i // GROUP][np.bitwise_count(changed) <= radius // BLOCKS] |= bit
        share = np.exp2(-np.bitwise_count(fixed).astype(float))  # of the values of a block, those in reach of an item
        left = [np.cumprod(share[g * GROUP : (g + 1) * GROUP], axis=1).sum(axis=0) for g in range(groups)]
        return cls(words, k, items, shingles, prints, reach, near, [min(BLOCKS, 1 + int((x > 0.15).sum())) for x in left])

    def probe(self, prints: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Places of fingerprints, and the items, whose blocks meet in the tables: all within radius that are in reach."""
        blocks = np.ascontiguousarray(prints).view(np.uint8).reshape(-1, BLOCKS)
        for g in range(len(self.reach)):
            at, met = None, None
            for some in (range(self.early[g]), range(self.early[g], BLOCKS)):
                for b in some:
                    own = self.reach[g, b].take(blocks[:, b] if at is None else blocks[at, b])
                    met = own if met is None else np.bitwise_and(met, own, out=met)
                kept = np.flatnonzero(met)
                at, met = kept if at is None else at[kept], met[kept]
            close = np.zeros(len(at), dtype=np.uint64)
            for b in range(BLOCKS):  # by the pigeonhole principle, some block of a fingerprint within radius is near
                close |= self.near[g, b][blocks[at, b]]
            met &= close
            kept = np.flatnonzero(met)
            at, met = at[kept], met[kept]
            if len(at):
                row, item = np.nonzero(np.unpackbits(met.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little"))
                yield at[row], item + g * GROUP


class Index:
    """Benchmark items by size."""

    def __init__(self, texts: list[str], width: int = WIDTH, radius: int = RADIUS, similarity: float = SIMILARITY):
        self.radius, self.similarity = radius, similarity
        sizes: dict[int, tuple[list[int], list[np.ndarray]]] = {}
        for i, text in enumerate(texts):
            hashes = find_words(pa.array([text or ""])).hashes()
            if len(hashes):
                items, shingles = sizes.setdefault(len(hashes), ([], []))
                items.append(i)
                shingles.append(grams(hashes, min(width, len(hashes))))
        self.classes: dict[int, list[SizeClass]] = {}
        for n, (items, shingles) in sorted(sizes.items()):
            k = min(width, n)
            self.classes.setdefault(k, []).append(SizeClass.of(n, k, items, shingles, similarity, radius))
        self.known = {}
        for k, own in self.classes.items():
            known = np.unique(np.concatenate([s for c in own for s in c.shingles]))
            bits = max(12, min(22, int(16 * len(known)).bit_length()))
            seen = np.zeros(1 << bits, dtype=bool)
            seen[known >> np.uint64(64 - bits)] = True
            self.known[k] = known, seen, np.uint64(64 - bits)

    def shared_least(self, a: int, b: int) -> int:
        """Shingles that two similar bags of so many have in common, at least."""
        return int(np.ceil((a + b) * self.similarity / (1 + self.similarity) - _SLACK))

    def places(self, shingles: np.ndarray, k: int) -> np.ndarray:
        """How many shingles of any item stand before each place."""
        known, seen, shift = self.known[k]
        at = np.flatnonzero(seen[shingles >> shift])
        place = np.minimum(np.searchsorted(known, shingles[at]), len(known) - 1)
        here = np.zeros(len(shingles) + 1, dtype=np.int32)
        here[at[known[place] == shingles[at]] + 1] = 1
        return np.cumsum(here, dtype=np.int32)

    def search(self, texts: pa.Array) -> list[tuple[int, int, float, int, int]]:
        """(text, item, similarity, first word, words) of the best window, the first of equals, for each text and item.

        Every window of an item's number of words gets a fingerprint, which is looked up in the block tables of the items of
        that size. Hits within radius that have enough shingles of items for the similarity are compared exactly.
        """
        w = find_words(texts)
        first, hashes, found = w.first, w.hashes(), []
        room = first[w.doc + 1] - np.arange(len(w.doc)) if len(w.doc) else np.zeros(0, np.int64)
        for k, classes in self.classes.items():
            shingles = grams(hashes, k)
            if not len(shingles):
                continue
            before, longest = self.places(shingles, k), classes[-1].size
            far = np.concatenate([shingles, np.zeros(longest + 1, np.uint64)])
            hits: list[tuple[SizeClass, np.ndarray, np.ndarray, int]] = []
            for begin in range(0, len(shingles), WINDOWS):
                count = min(WINDOWS, len(shingles) - begin)
                balance = Balance(far[begin:], count, longest)
                for c in classes:
                    prints = balance.grow(c.size)
                    for at, item in c.probe(prints):
                        near = np.bitwise_count(prints[at] ^ c.prints[item]) <= self.radius
                        at, item = at[near] + begin, item[near]
                        whole = room[at] >= c.words
                        at, item = at[whole], item[whole]
                        enough = before[at + c.size] - before[at] >= self.shared_least(c.size, c.size)
                        if enough.any():
                            hits.append((c, at[enough], item[enough], c.size))
            hits += self._short(classes, k, first, shingles, before)
            found += self._compared(hits, w.doc, first, shingles)
        return found

    def _short(self, classes: list[SizeClass], k: int, first: np.ndarray, shingles: np.ndarray, before: np.ndarray) -> Iterator[tuple[SizeClass, np.ndarray, np.ndarray, int]]:
        """Hits of whole texts that are shorter than an item."""
        counts = np.diff(first)
        for d in np.flatnonzero((counts >= k) & (counts < classes[-1].words)).tolist():
            size, at, print_ = int(counts[d]) - k + 1, int(first[d]), None
            for c in classes:
                if c.size > size >= self.similarity * c.size - _SLACK and before[at + size] - before[at] >= self.shared_least(size, c.size):
                    if print_ is None:
                        print_ = simhash_rows(signs(shingles[at : at + size]).sum(axis=0)[None, :])
                    for places, items in c.probe(print_):
                        near = np.bitwise_count(print_[places] ^ c.prints[items]) <= self.radius
                        yield c, places[near] + at, items[near], size

    def _compared(self, hits: list, doc: np.ndarray, first: np.ndarray, shingles: np.ndarray) -> list[tuple[int, int, float, int, int]]:
        """The best window of each text and item among the hits; windows of equal bags of shingles are compared once."""
        if not hits:
            return []
        with np.errstate(over="ignore"):
            total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mix(shingles), dtype=np.uint64)))  # differences tell bags apart
        rows = [(c, size, doc[at].astype(np.int64) * len(c.items) + item, at) for c, at, item, size in hits]
        by_class: dict[tuple[int, int], list] = {}
        for c, size, owner, at in rows:
            by_class.setdefault((id(c), size), [c]).append((owner, at))
        best: dict[tuple[int, int], tuple[float, int, int]] = {}
        for (_, size), (c, *parts) in by_class.items():
            owner, at = (np.concatenate([p[i] for p in parts]) for i in (0, 1))
            order = np.lexsort((at, owner))
            owner, at = owner[order], at[order]
            for own, places in zip(owner[np.flatnonzero(np.diff(owner, prepend=-1))].tolist(), np.split(at, np.flatnonzero(np.diff(owner)) + 1)):
                d, item = divmod(own, len(c.items))
                _, once = np.unique(total[places + size] - total[places], return_index=True)
                for p in places[np.sort(once)].tolist():
                    got = weighted_similarity(shingles[p : p + size], c.shingles[item])
                    if got >= self.similarity and got > best.get((d, c.items[item]), (0.0,))[0]:
                        best[d, c.items[item]] = (got, p - int(first[d]), size + c.k - 1)
                    if got == 1:
                        break
        return [(d, i, got, start, n) for (d, i), (got, start, n) in best.items()]


def _passes(benchmark: DataFrame, similarity: float, width: int, item_col: str, item_text_col: str):
    """(index, ids) of each PASS_BYTES of benchmark text, shared with the executors; at least one."""
    items = two_columns(benchmark, item_col, item_text_col)
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    count = max(1, -(-size // PASS_BYTES))
    for p in range(count):
        some = items.filter(F.pmod(F.xxhash64("doc_id", "text"), F.lit(count)) == p).select("doc_id", "text").collect()
        yield benchmark.sparkSession.sparkContext.broadcast((Index([r[1] for r in some], width, similarity=similarity), [r[0] for r in some]))


def matches(docs: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY, width: int = WIDTH, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """(doc_id, item_id, similarity double, first_word long, n_words long) for each row of docs and each item it holds.

    A document holds an item if a window of the item's number of words, or the whole of a shorter text, has a weighted
    similarity of shingles of width words to the item of at least similarity; the best window is returned. Shorter items
    are one shingle. Documents are read in one pass without a shuffle, or in one for each PASS_BYTES of benchmark text.
    Null and empty texts and items hold nothing; ids may be null or repeat; repeated items are found under each id.
    """
    fields = [("doc_id", id_type(docs, id_col)), ("item_id", id_type(benchmark, item_col)), ("similarity", T.DoubleType()), ("first_word", T.LongType()), ("n_words", T.LongType())]
    out = None
    for shared in _passes(benchmark, similarity, width, item_col, item_text_col):

        def make(shared=shared):
            index, ids_of = shared.value

            def f(ids: pa.Array, texts: pa.Array) -> list | None:
                rows = index.search(texts)
                if not rows:
                    return None
                d, i, s, a, n = zip(*rows)
                return [ids.take(pa.array(d)), pa.array([ids_of[x] for x in i]), np.array(s), np.array(a, dtype=np.int64), np.array(n, dtype=np.int64)]

            return f

        one = map_texts(docs, fields, make, id_col, text_col)
        out = one if out is None else out.unionByName(one)
    return out


def clean(docs: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY, width: int = WIDTH, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """The rows of docs that hold no item, with all their columns. Each row is judged by its own text, whatever its id."""
    for shared in _passes(benchmark, similarity, width, item_col, item_text_col):

        def make(shared=shared):
            index, _ = shared.value

            def f(texts: pa.Array) -> np.ndarray:
                free = np.ones(len(texts), dtype=bool)
                free[[r[0] for r in index.search(texts)]] = False
                return free

            return f

        docs = docs.filter(text_udf(make, "boolean")(F.col(text_col).cast("string")))
    return docs
