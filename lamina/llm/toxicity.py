"""Toxicity by a factorization machine over hashed terms."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lamina.llm.labelled import fold, sample
from lamina.llm.words import Words, find_words, id_type, map_texts, mix, release, sliced, text_udf

#: Labelled documents of each class that the model is fitted on, at most.
SAMPLE = 4000
BUCKET_BITS = 20
#: Terms: whole words, and the first bytes of longer ones.
PREFIXES = (4, 5, 6)
TERMS, FACTORS, EPOCHS = 1024, 4, 60
#: Terms whose pairs are looked at, most seen first, and pairs that bring their terms in.
PAIRED, PAIRS = 1024, 64
THRESHOLD = 0.3


def buckets(w: Words) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each kind of term: the text of each word that has one, and the term's bucket."""
    shift = np.uint64(64 - BUCKET_BITS)
    with np.errstate(over="ignore"):
        yield w.doc, (mix(w.hashes(), 1) >> shift).astype(np.int32)
        for n in PREFIXES:
            longer = w.end - w.start > n
            yield w.doc[longer], (mix(w.hashes(n)[longer], n) >> shift).astype(np.int32)


def terms(texts: pa.Array) -> list[np.ndarray]:
    """The distinct buckets of each text."""
    pairs = [(d.astype(np.int64) << BUCKET_BITS) | b for d, b in buckets(find_words(texts))]
    own = np.unique(np.concatenate(pairs))
    return np.split((own & ((1 << BUCKET_BITS) - 1)).astype(np.int32), np.searchsorted(own, np.arange(1, len(texts), dtype=np.int64) << BUCKET_BITS))


@dataclass
class Machine:
    """score = sigmoid(bias + sum of weights + sum over pairs of the dot products of factors) over a text's known terms."""

    bias: float
    weights: np.ndarray
    factors: np.ndarray
    #: The number of a bucket's term, from 1; 0 if it has none.
    number: np.ndarray

    def margins(self, rows: np.ndarray, term: np.ndarray, count: int) -> np.ndarray:
        """rows: the text of each term; each term once for a text."""
        v = self.factors[term]
        sums = np.stack([np.bincount(rows, v[:, k], count) for k in range(v.shape[1])], axis=1) if len(rows) else np.zeros((count, v.shape[1]))
        return self.bias + np.bincount(rows, self.weights[term] - 0.5 * (v * v).sum(axis=1), count) + 0.5 * (sums * sums).sum(axis=1)

    def scores(self, texts: pa.Array) -> np.ndarray:
        pairs = []
        for doc, bucket in buckets(find_words(texts)):
            term = self.number[bucket]
            known = np.flatnonzero(term)
            pairs.append(doc[known].astype(np.int64) * len(self.weights) + term[known])
        own = np.unique(np.concatenate(pairs))
        margin = self.margins(own // len(self.weights), own % len(self.weights), len(texts))
        return 1 / (1 + np.exp(-np.clip(margin, -35, 35)))


def difference(share: list[np.ndarray]) -> np.ndarray:
    """How far apart the shares of two classes are, in about their standard deviations."""
    return np.abs(share[1] - share[0]) / np.sqrt((share[0] * (1 - share[0]) + share[1] * (1 - share[1])) + 0.002)


def paired_terms(row: np.ndarray, bucket: np.ndarray, labels: np.ndarray, seen: np.ndarray, pull: np.ndarray, classes: dict[int, int]) -> np.ndarray:
    """Terms of the pairs that tell the classes apart further than either of their terms does, whatever the terms do alone.

    Of the PAIRED terms seen most; as many pairs as a quarter of the smaller class, PAIRS at most.
    """
    often = np.sort(np.argsort(-seen, kind="stable")[:PAIRED])
    often = often[seen[often] >= 3]
    place = np.full(len(seen), -1)
    place[often] = np.arange(len(often))
    known = place[bucket] >= 0
    x = np.zeros((len(labels), len(often)), dtype=np.float32)
    x[row[known], place[bucket[known]]] = 1
    both = [x[labels == c].T @ x[labels == c] for c in (0, 1)]
    further = difference([both[c] / classes[c] for c in (0, 1)]) - np.maximum(pull[often][:, None], pull[often][None, :])
    further[(both[0] + both[1] < 3) | np.tri(len(often), dtype=bool)] = 0
    top = np.argsort(-further, axis=None, kind="stable")[: min(PAIRS, min(classes.values()) // 4)]
    top = top[further.ravel()[top] > 0]
    return often[np.unique(np.concatenate(np.unravel_index(top, further.shape)))] if len(top) else often[:0]


def fit(rows: list[np.ndarray], labels: np.ndarray, sizes: dict[int, int], seed: int = 7) -> Machine:
    """A machine over the terms that tell the classes apart best, alone or in pairs, by Adam on the weighted log loss.

    At most TERMS of the first kind, and no more than four times the rows of the smaller class, against chance.

    Each class weighs as in the whole of the labels (sizes), whatever its share of the sample. With no label or only one
    class the machine has a bias alone.
    """
    number = np.zeros(1 << BUCKET_BITS, dtype=np.int32)
    total = max(sum(sizes.values()), 1)
    rate = (sizes.get(1, 0) + 0.5) / (total + 1)
    machine = Machine(float(np.log(rate / (1 - rate))), np.zeros(1), np.zeros((1, FACTORS)), number)
    classes = {int(c): int(n) for c, n in zip(*np.unique(labels, return_counts=True))}
    if len(classes) < 2:
        return machine
    weight = np.array([sizes[c] / classes[c] / total for c in labels.tolist()])
    weight *= len(labels) / weight.sum()
    row = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    bucket = np.concatenate(rows)
    share = [np.bincount(bucket[labels[row] == c], minlength=len(number)) / classes[c] for c in (0, 1)]
    seen = np.bincount(bucket, minlength=len(number))
    pull = difference(share)
    pull[seen < 3] = 0
    best = np.argsort(-pull, kind="stable")[: min(TERMS, 4 * min(classes.values()))]
    best = np.union1d(best[pull[best] > 0], paired_terms(row, bucket, labels, seen, pull, classes))
    number[best] = np.arange(1, len(best) + 1)
    keep = number[bucket] > 0
    row, term = row[keep], number[bucket[keep]]
    rng = np.random.default_rng(seed)
    w, v, bias = np.zeros(len(best) + 1), rng.normal(0, 0.01, (len(best) + 1, FACTORS)), machine.bias
    state = [[np.zeros_like(x), np.zeros_like(x)] for x in (w, v, np.zeros(1))]
    n = len(rows)
    for epoch in range(1, EPOCHS + 1):
        x = v[term]
        sums = np.stack([np.bincount(row, x[:, k], n) for k in range(FACTORS)], axis=1)
        margin = bias + np.bincount(row, w[term] - 0.5 * (x * x).sum(axis=1), n) + 0.5 * (sums * sums).sum(axis=1)
        slope = weight * (1 / (1 + np.exp(-np.clip(margin, -35, 35))) - labels) / n
        each = slope[row]
        grad_v = np.stack([np.bincount(term, each * (sums[row, k] - x[:, k]), len(w)) for k in range(FACTORS)], axis=1)
        grads = (np.bincount(term, each, len(w)) + 1e-5 * w, grad_v + 1e-4 * v, np.array([slope.sum()]))
        steps = []
        for g, (m, s) in zip(grads, state):
            m += 0.1 * (g - m)
            s += 0.01 * (g * g - s)
            steps.append(m / (1 - 0.9**epoch) / (np.sqrt(s / (1 - 0.99**epoch)) + 1e-9))
        w, v, bias = w - 0.1 * steps[0], v - 0.02 * steps[1], bias - 0.1 * float(steps[2][0])
    w[0], v[0] = 0, 0
    return Machine(float(bias), w, v, number)


def train(docs: DataFrame, labels: DataFrame, folds: int = 4, held: int = 2, most: int = SAMPLE, id_col: str = "doc_id", text_col: str = "text", target: str = "toxic") -> Machine:
    """A machine fitted on at most `most` labelled documents of each class outside the held fold.

    Each of their texts sends its distinct terms to the driver; nothing but the text and the label is read.
    """
    picked, sizes = sample(docs, labels, target, folds, held, most, id_col, text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in sliced(batch, 0):
                yield pa.RecordBatch.from_arrays([pa.array(terms(piece.column(0)), pa.list_(pa.int32())), piece.column(1)], names=["terms", "label"])

    got = picked.select("text", "label").mapInArrow(run, "terms array<int>, label int").toArrow()
    rows = [np.asarray(x, dtype=np.int32) for x in (r.values.to_numpy(zero_copy_only=False) for chunk in got.column("terms").chunks for r in chunk)]
    order = sorted(range(len(rows)), key=lambda i: (got.column("label")[i].as_py(), len(rows[i]), rows[i].tobytes()))  # whatever order tasks end in
    machine = fit([rows[i] for i in order], got.column("label").to_numpy()[order].astype(np.float64), sizes)
    del got, rows
    release()
    return machine


def score(docs: DataFrame, machine: Machine, folds: int = 4, held: int = 2, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, held_out boolean, score double, predicted int) for every row of docs, in one pass without a shuffle.

    A null or empty text has the score of the bias. held_out is false for a null id. Repeated rows give repeated rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(machine)  # of fixed size: 4 MB of bucket numbers

    def make():
        m = shared.value
        return lambda ids, texts: [ids, m.scores(texts)]

    scored = map_texts(docs, [("doc_id", id_type(docs, id_col)), ("score", T.DoubleType())], make, id_col, text_col)
    return scored.select("doc_id", F.coalesce(fold("doc_id", folds) == held, F.lit(False)).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def clean(docs: DataFrame, machine: Machine, threshold: float = THRESHOLD, text_col: str = "text") -> DataFrame:
    """The rows of docs that score below the threshold, with all their columns."""
    shared = docs.sparkSession.sparkContext.broadcast(machine)

    def make():
        m = shared.value
        return lambda texts: m.scores(texts)

    return docs.filter(text_udf(make, "double")(F.col(text_col).cast("string")) < threshold)
