"""Hard negatives and centroid clustering against plain forms, with edge cases."""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pytest

from lamina.llm import hard_negatives, kmeans

ROWS = "vec_id long, embedding array<double>, label int, row string, key string, v int, cluster string, id string, window int, leaf int"
MORE = ("r", "k", 1, "c", "i", 2, 3)


def rows_of(kind: str) -> list[tuple]:
    rng = np.random.default_rng(5)
    if kind == "plain":
        return [(i, rng.normal(size=6).tolist(), int(rng.integers(3))) for i in range(500)]
    if kind == "ties":  # few different vectors, many copies, repeated ids, one label for a third of all rows
        few = rng.integers(-2, 3, size=(9, 6)).astype(float).tolist()
        return [(int(rng.integers(700)), few[int(rng.integers(9))], int(rng.integers(4))) for _ in range(500)] + [(i, few[0], 1) for i in range(300)]
    odd = [(0, None, 1), (100, [1.0] * 6, None), (None, [1.0] * 6, 1), (200, [1.0] * 5, 1), (300, [math.nan] * 6, 1), (400, [math.inf] + [0.0] * 5, 2), (500, [None] + [0.0] * 5, 2), (600, [1e300] * 6, 1), (700, [0.0] * 6, 1), (800, [], 1)]
    return odd + [(i, rng.normal(size=6).tolist(), int(rng.integers(2))) for i in range(900, 960)]


def frame(spark, rows):
    return spark.createDataFrame([(*r, *MORE) for r in rows], ROWS)


def plain_negatives(rows: list[tuple]) -> list[tuple]:
    good = [(n, i, [math.floor(256 * x) for x in v], label) for n, (i, v, label) in enumerate(rows) if None not in (i, v, label) and len(v) == 6 and all(x is not None and math.isfinite(x) and abs(x) < 1e9 for x in v)]
    out = []
    for n, i, q, label in good:
        if i % 100:
            continue
        scored = sorted((-sum(a * b for a, b in zip(q, v)), j, m, other) for m, j, v, other in good if m != n)
        for s, j, _, _ in [x for x in scored if x[3] == label][:5]:
            hard = [x for x in scored if x[3] != label and 30 * -s <= 100 * -x[0] <= 90 * -s][:10]
            out += [(i, j, rank, x[1], -s, -x[0]) for rank, x in enumerate(hard, 1)]
    return sorted(out)


@pytest.mark.parametrize("kind", ["plain", "ties", "odd"])
def test_negatives_equal_brute_force(spark, kind, monkeypatch):
    monkeypatch.setattr(hard_negatives, "LEAF_ROWS", 16)  # a tree of many leaves
    rows = rows_of(kind)
    got = hard_negatives.mine(frame(spark, rows)).collect()
    assert sorted(map(tuple, got)) == plain_negatives(rows)


def test_negatives_of_nothing(spark):
    empty = frame(spark, rows_of("plain")).limit(0)
    assert hard_negatives.mine(empty).count() == 0
    assert hard_negatives.mine(frame(spark, [(1, [1.0] * 6, 1)])).count() == 0  # no anchor
    assert hard_negatives.mine(frame(spark, [(100, [1.0] * 6, 1)])).count() == 0  # no other row
    assert hard_negatives.mine(empty).columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


def test_walk_opens_the_annulus_only():
    rng = np.random.default_rng(2)
    x = np.rint(rng.normal(size=(3000, 3)) * 100).astype(np.int64)
    reach2 = int((x * x).sum(axis=1).max()) + 1
    tree = hard_negatives.fit(x, reach2, 32)
    leaf, tree.bounds = tree.place(x)
    opened = 0
    for q in x[:20]:
        s = x @ q
        low, high = int(np.quantile(s, 0.7)), int(np.quantile(s, 0.8))
        walked = list(tree.walk(q, tree.circle(q, high), tree.circle(q, low)))
        assert set(leaf[(s >= low) & (s <= high)]) <= set(walked) and len(walked) == len(set(walked))
        opened += len(walked)
    assert set(tree.walk(np.zeros(3), 1.0, 1.0)) == set(leaf)  # all scores of a zero anchor are equal
    assert opened < 20 * 0.8 * tree.leaves


def plain_clusters(rows: list[tuple], dims: int, k: int, rounds: int) -> list[tuple]:
    good = [(i, [math.floor(1024 * x) for x in v]) for i, v, _ in rows if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) and abs(x) < 1e5 for x in v)]
    order = sorted(good, key=lambda r: (r[0] is None, hashlib.sha256(f"3:{r[0]}".encode()).hexdigest(), r[1]))
    centres = [v for _, v in order[:k]]

    def near(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(centres))

    for _ in range(rounds):
        at = [near(v)[1] for _, v in good]
        for c in range(len(centres)):
            mine = [v for (_, v), a in zip(good, at) if a == c]
            if mine:
                centres[c] = [sum(col) // len(mine) for col in zip(*mine)]
    found = [(i, *near(v)[::-1]) for i, v in good]
    inertia = {c: sum(d for _, a, d in found if a == c) for _, c, _ in found}
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centres]
    return sorted(((i, c, d, inertia[c], sum(inertia.values()), digest[c]) for i, c, d in found), key=repr)


@pytest.mark.parametrize("kind", ["plain", "ties", "odd"])
def test_clusters_equal_the_plain_rounds(spark, kind):
    rows = rows_of(kind)
    got = kmeans.cluster(frame(spark, rows), k=8, rounds=7, dims=6)
    assert sorted(map(tuple, got.collect()), key=repr) == plain_clusters(rows, 6, 8, 7)


def test_clusters_of_little(spark):
    few = [(1, [0.5] * 6, 1), (2, [-0.5] * 6, 1), (2, [-0.5] * 6, 1)]
    assert sorted(map(tuple, kmeans.cluster(frame(spark, few), dims=6).collect()), key=repr) == plain_clusters(few, 6, 8, 10)
    none = kmeans.cluster(frame(spark, few), dims=64)
    assert none.count() == 0 and none.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]


def test_scan_stops_and_stays_exact():
    rng = np.random.default_rng(3)
    for _ in range(30):
        x, centres = rng.integers(-4, 5, size=(200, 3)), rng.integers(-4, 5, size=(9, 3))
        d = ((x[:, None, :] - centres[None]) ** 2).sum(axis=2)
        at, least = kmeans.assign(x, rng.integers(0, 9, size=200).astype(np.int32), centres)
        assert (at == d.argmin(axis=1)).all() and (least == d.min(axis=1)).all()
