"""Fingerprints of windows against plain ones, and bounds of time and memory with very many items and very long texts."""

from __future__ import annotations

import random
import time
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from lamina.llm import decontaminate
from lamina.llm.decontaminate import Balance, Index, signs, simhash_rows


@pytest.mark.parametrize("sizes", [[1], [1, 2, 3, 4, 5], [7, 8, 9, 30, 31, 64, 65, 200], [13, 400], [127, 128, 129, 1000]])
def test_fingerprints_equal_sums(sizes):
    rng = np.random.default_rng(3)
    shingles = rng.integers(0, 1 << 63, 1400, dtype=np.uint64) * 2 + rng.integers(0, 2, 1400, dtype=np.uint64)
    shingles[100:160] = shingles[100]
    balance = Balance(shingles, 300, sizes[-1])
    for n in sizes:
        want = simhash_rows(np.stack([signs(shingles[i : i + n]).sum(axis=0) for i in range(300)]))
        assert (balance.grow(n) == want).all(), n


def prose(rng: random.Random, n: int) -> str:
    return " ".join("".join(rng.choices("abcdefgh", k=4)) for _ in range(n))


def test_tables_hold_every_similar_window():
    """Windows that differ from an item by as many shingles as the similarity allows are found, in each group of items."""
    rng = random.Random(2)
    items = [prose(rng, 40) for _ in range(150)]
    index = Index(items)
    for i in (0, 63, 64, 149):
        item = items[i].split()
        for changed in ([0], [39], [20], [0, 1, 2], [0, 38, 39]):
            text = prose(rng, 30) + " " + " ".join("x" if n in changed else w for n, w in enumerate(item)) + " " + prose(rng, 9)
            least = 36 - sum(1 for s in range(36) if any(s <= n <= s + 4 for n in changed))
            got = index.search(pa.array([text]))
            assert [g[1] for g in got] == ([i] if least / (72 - least) >= 0.8 else []), changed


def test_very_many_items_of_one_size():
    rng = random.Random(6)
    items = [prose(rng, 20) for _ in range(8000)]
    index = Index(items)
    text = f"{prose(rng, 3000)} {items[17]} {prose(rng, 2600)} {items[7999]}"
    began = time.process_time()
    tracemalloc.start()
    got = index.search(pa.array([text]))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert sorted((i, s, a, n) for _, i, s, a, n in got) == [(17, 1.0, 3000, 20), (7999, 1.0, 5620, 20)]
    assert time.process_time() - began < 3 and peak < 60 << 20


@pytest.mark.parametrize("kind", ["prose", "one item again and again", "noisy copies"])
def test_very_long_text(kind):
    rng = random.Random(7)
    items = [prose(rng, n) for n in (400, 400, 30, 31, 8)]
    index = Index(items)
    if kind == "prose":
        text = f"{prose(rng, 500_000)} {items[1]} {prose(rng, 500_000)}"
    elif kind == "one item again and again":
        text = " ".join([items[1]] * 2500)
    else:
        words = items[1].split()
        text = " ".join(" ".join(w if rng.random() > 0.01 else "x" for w in words) for _ in range(2500))
    began = time.process_time()
    tracemalloc.start()
    got = index.search(pa.array([text]))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert [g[1] for g in got] == [1] and (kind != "prose" or got[0][2:] == (1.0, 500_000, 400))
    assert time.process_time() - began < 40 and peak < 500 << 20, (time.process_time() - began, peak >> 20)


def test_repeated_items_and_clashing_columns(spark):
    docs = spark.createDataFrame([(1, "x one two three four five six seven y", 5, 6.0), (None, "One two three four five six seven", 5, 6.0)], "doc_id long, text string, item_id int, similarity double")
    items = spark.createDataFrame([(3, "one two three four five six seven", 1), (3, "one two three four five six seven", 1), (None, "one two three four five six seven", 1)], "item_id long, text string, first_word int")
    got = sorted((r.doc_id or 0, r.item_id or 0, r.similarity, r.first_word, r.n_words) for r in decontaminate.matches(docs, items).collect())
    assert got == [(0, 0, 1.0, 0, 7), (0, 3, 1.0, 0, 7), (0, 3, 1.0, 0, 7), (1, 0, 1.0, 1, 7), (1, 3, 1.0, 1, 7), (1, 3, 1.0, 1, 7)]
