"""The classifiers against plain forms: a dense factorization machine, exact ridge equations, isotonic values by their formula."""

from __future__ import annotations

import random
from itertools import combinations

import numpy as np
import pyarrow as pa

from lamina.llm import labelled, quality, toxicity


def some_texts(n: int, seed: int = 4) -> list[str]:
    rng = random.Random(seed)
    words = "garden budget winter people market idiot scum signal forest letter".split()
    return [" ".join(rng.choices(words, k=rng.randint(1, 12))) for _ in range(n)]


def test_sample_is_bounded_in_rows(spark):
    texts = some_texts(2000)
    docs = spark.createDataFrame([(7, t) for t in texts] + [(i, t) for i, t in enumerate(texts[:50]) if i != 7], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(50)], "doc_id long, toxic int")
    for most in (1, 5, 100):
        picked, sizes = labelled.sample(docs, labels, "toxic", 4, 2, most)
        rows = picked.collect()
        assert len(rows) == sum(min(most, n) for n in sizes.values())
    again = sorted(tuple(r) for r in labelled.sample(docs.repartition(7), labels, "toxic", 4, 2, 100)[0].collect())
    assert again == sorted(tuple(r) for r in rows)


def test_machine_equals_a_plain_one():
    texts = some_texts(160)
    labels = np.array([float("idiot" in t and "market" in t) for t in texts])
    sizes = {0: int((labels == 0).sum()), 1: int(labels.sum())}
    rows = toxicity.terms(pa.array(texts))
    got = toxicity.fit(rows, labels, sizes)
    # the same descent over a dense table of texts and terms
    count = len(got.weights)
    x = np.zeros((len(texts), count))
    for i, r in enumerate(rows):
        x[i, got.number[r]] = 1
    x[:, 0] = 0
    rng = np.random.default_rng(7)
    w, v = np.zeros(count), rng.normal(0, 0.01, (count, toxicity.FACTORS))
    rate = (sizes[1] + 0.5) / (len(texts) + 1)
    bias, state = np.log(rate / (1 - rate)), [[0.0, 0.0] for _ in range(3)]
    for epoch in range(1, toxicity.EPOCHS + 1):
        margin = bias + x @ w + 0.5 * (((x @ v) ** 2).sum(axis=1) - ((x**2) @ (v**2)).sum(axis=1))
        slope = (1 / (1 + np.exp(-margin)) - labels) / len(texts)
        grads = (x.T @ slope + 1e-5 * w, x.T @ (slope[:, None] * (x @ v)) - (x.T @ slope)[:, None] * v + 1e-4 * v, slope.sum())
        steps = []
        for g, s in zip(grads, state):
            s[0], s[1] = s[0] + 0.1 * (g - s[0]), s[1] + 0.01 * (g * g - s[1])
            steps.append(s[0] / (1 - 0.9**epoch) / (np.sqrt(s[1] / (1 - 0.99**epoch)) + 1e-9))
        w, v, bias = w - 0.1 * steps[0], v - 0.02 * steps[1], bias - 0.1 * steps[2]
    assert np.allclose(got.weights[1:], w[1:], atol=1e-6) and np.allclose(got.factors[1:], v[1:], atol=1e-6) and np.isclose(got.bias, bias, atol=1e-6)
    # scores by every pair of terms
    for i, p in enumerate(got.scores(pa.array(texts))):
        known = [t for t in sorted(set(got.number[rows[i]].tolist())) if t]
        margin = got.bias + sum(got.weights[t] for t in known) + sum(got.factors[a] @ got.factors[b] for a, b in combinations(known, 2))
        assert np.isclose(p, 1 / (1 + np.exp(-margin)))


def test_ridge_equals_exact_equations(spark):
    rng = random.Random(2)
    docs = [(i, t.upper() + "!!" if rng.random() < 0.5 else t) for i, t in enumerate(some_texts(300))]
    labels = [(i, int(not t.endswith("!!"))) for i, t in docs]
    frame, marks = spark.createDataFrame(docs, "doc_id long, text string").repartition(6), spark.createDataFrame(labels, "doc_id long, quality int")
    model = quality.train(frame, marks)
    picked, sizes = labelled.sample(frame, marks, "quality", 5, 0, quality.SAMPLE)
    rows = picked.collect()
    stats, label, half = quality.statistics(pa.array([r.text for r in rows])), np.array([r.label for r in rows], float), np.array([r.half for r in rows])
    share = {c: sizes[c] / sum(sizes.values()) for c in sizes}
    weight = np.array([share[int(y)] / ((label == y) & (half == h)).sum() for y, h in zip(label, half)])
    fit = half == 0
    assert np.allclose(model.mean, np.average(stats[fit], axis=0, weights=weight[fit]))
    z = model.features(stats[fit])
    penalty = quality.RIDGE * (weight[fit][:, None] * z * z).sum() / z.shape[1]
    # least squares over the rows and one row for each penalty, without normal equations
    a = np.concatenate([np.sqrt(weight[fit])[:, None] * z, np.sqrt(penalty) * np.eye(z.shape[1])])
    exact = np.linalg.lstsq(a, np.concatenate([np.sqrt(weight[fit]) * label[fit], np.zeros(z.shape[1])]), rcond=None)[0]
    assert np.allclose(model.weights, exact, atol=1e-7)
    raw = model.features(stats[~fit]) @ model.weights
    order = np.argsort(raw)
    y, m = label[~fit][order], weight[~fit][order]
    mean = lambda a, b: (y[a : b + 1] * m[a : b + 1]).sum() / m[a : b + 1].sum()
    values = [max(min(mean(a, b) for b in range(i, len(y))) for a in range(i + 1)) for i in range(len(y))]
    assert np.allclose(model.scores(pa.array([rows[i].text for i in np.flatnonzero(~fit)[order]])), values)


def test_terms_that_matter_in_pairs_only_are_kept():
    """Two words of equal share in both classes, told apart by standing together, among far more words than there are terms."""
    rng = random.Random(12)
    noise = ["".join(rng.choices("abcdefgh", k=3)) for _ in range(1500)]
    texts, labels = [], []
    for n in range(1200):
        label = n % 2
        both = rng.random() < 0.5
        pair = (["zyx", "qpo"] if both else []) if label else [("zyx", "qpo")[rng.random() < 0.5]]
        texts.append(" ".join(rng.sample(noise, 20) + pair))
        labels.append(float(label))
    labels = np.array(labels)
    rows = toxicity.terms(pa.array(texts))
    machine = toxicity.fit(rows[:1000], labels[:1000], {0: 500, 1: 500})
    wanted = [int(toxicity.terms(pa.array([w]))[0][0]) for w in ("zyx", "qpo")]
    assert all(machine.number[wanted])
    together, one = machine.scores(pa.array(["zyx qpo", "zyx"]))
    assert together > 0.5 and together > one + 0.1
