"""Quality by ridge regression on random Fourier features of document statistics, with isotonic calibration."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lamina.llm.labelled import fold, sample
from lamina.llm.store import cut
from lamina.llm.words import find_words, id_type, map_texts, sliced, text_buffer

#: Labelled documents of each class that the model is fitted and calibrated on, at most.
SAMPLE = 6000
FEATURES, WIDTH, RIDGE = 256, 3.0, 1e-3
#: Tasks that sum the normal equations, each sending one matrix.
PARTS = 8
THRESHOLD = 0.3

_KINDS = np.zeros((10, 256), dtype=bool)
_KINDS[0, 65:91] = True
_KINDS[1, 97:123] = True
_KINDS[2, 48:58] = True
_KINDS[3, [32, *range(9, 14)]] = True
_KINDS[4, 10] = True
_KINDS[5, 128:] = True
_KINDS[6, list(b".,;:'\"()-")] = True
_KINDS[7, list(b"#$%&*@^~+=<>\\/_")] = True
_KINDS[8, list(b"|{}[]")] = True
_KINDS[9, list(b"!?")] = True


def statistics(texts: pa.Array) -> np.ndarray:
    """A row for each text: sizes, shares of kinds of bytes, word lengths, and how far words repeat."""
    data, offsets = text_buffer(texts)
    n = len(texts)
    doc = np.repeat(np.arange(n), np.diff(offsets))
    size = np.maximum(np.diff(offsets), 1)
    columns = [np.log1p(np.diff(offsets))]
    columns += [np.bincount(doc[kind[data]], minlength=n) / size for kind in _KINDS]
    w = find_words(texts)
    count, hashes, length = np.maximum(w.counts, 1), w.hashes(), w.end - w.start
    again = np.zeros(len(hashes), dtype=bool)
    again[1:] = (hashes[1:] == hashes[:-1]) & (w.doc[1:] == w.doc[:-1])
    order = np.lexsort((hashes, w.doc))
    new = np.ones(len(order), dtype=bool)
    new[1:] = (hashes[order][1:] != hashes[order][:-1]) | (w.doc[order][1:] != w.doc[order][:-1])
    distinct = np.bincount(w.doc[order][new], minlength=n)
    columns += [np.log1p(w.counts), np.bincount(w.doc, length, n) / count, np.bincount(w.doc[again], minlength=n) / count, distinct / count, distinct / np.sqrt(count)]
    columns += [np.bincount(w.doc[length <= 3], minlength=n) / count]
    return np.stack(columns, axis=1)


@dataclass
class Model:
    mean: np.ndarray
    spread: np.ndarray
    directions: np.ndarray
    shifts: np.ndarray
    weights: np.ndarray
    #: The isotonic map: a score at least edges[i] is worth values[i].
    edges: np.ndarray
    values: np.ndarray

    def features(self, stats: np.ndarray) -> np.ndarray:
        """Cosines whose dot products approximate a Gaussian kernel of the standardised statistics, and a constant."""
        x = np.clip((stats - self.mean) / self.spread, -8, 8)
        z = np.sqrt(2 / len(self.shifts)) * np.cos(x @ self.directions + self.shifts)
        return np.concatenate([z, np.ones((len(z), 1))], axis=1)

    def scores(self, texts: pa.Array) -> np.ndarray:
        raw = self.features(statistics(texts)) @ self.weights
        return self.values[np.maximum(np.searchsorted(self.edges, raw, side="right") - 1, 0)]


def isotonic(raw: np.ndarray, labels: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The non-decreasing step function nearest to the labels, by pooling adjacent violators: steps' edges and values."""
    edges, first = np.unique(raw, return_inverse=True)
    mass, total = np.bincount(first, weights), np.bincount(first, weights * labels)
    steps: list[list[float]] = []
    for e, m, t in zip(edges.tolist(), mass.tolist(), total.tolist()):
        steps.append([e, m, t])
        while len(steps) > 1 and steps[-2][2] / steps[-2][1] >= steps[-1][2] / steps[-1][1]:
            _, m, t = steps.pop()
            steps[-1][1] += m
            steps[-1][2] += t
    return np.array([s[0] for s in steps]), np.array([s[2] / s[1] for s in steps])


def train(docs: DataFrame, labels: DataFrame, folds: int = 5, held: int = 0, most: int = SAMPLE, id_col: str = "doc_id", text_col: str = "text", target: str = "quality", seed: int = 11) -> Model:
    """A model fitted on at most `most` labelled documents of each class outside the held fold.

    One half gives the statistics' means and spreads and the normal equations of the ridge regression, which PARTS tasks
    sum up; the other half calibrates. Each class weighs as in the whole of the labels. With only one class, or no label,
    every score is the share of label 1 (a half without labels).
    """
    picked, sizes = sample(docs, labels, target, folds, held, most, id_col, text_col)
    total = sum(sizes.values())
    stats_of = map_statistics(picked)
    return _train(cut(stats_of.repartition(PARTS).sortWithinPartitions("half", "label", "stats")), sizes, total, seed)


def map_statistics(picked: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in sliced(batch, 0):
                stats = statistics(piece.column(0))
                offsets = np.arange(0, stats.size + 1, stats.shape[1], dtype=np.int32)
                yield pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(pa.array(offsets), pa.array(stats.ravel())), piece.column(1), piece.column(2)], names=["stats", "label", "half"])

    return picked.select("text", "label", "half").mapInArrow(run, "stats array<double>, label int, half int")


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy().reshape(len(column), -1)


def _train(rows: DataFrame, sizes: dict[int, int], total: int, seed: int) -> Model:
    rng = np.random.default_rng(seed)
    dims = statistics(pa.array([""])).shape[1]
    flat = Model(np.zeros(dims), np.ones(dims), rng.normal(0, 1 / WIDTH, (dims, FEATURES)), rng.uniform(0, 2 * np.pi, FEATURES), np.zeros(FEATURES + 1), np.array([-np.inf]), np.array([sizes.get(1, 0) / total if total else 0.5]))
    taken = {(r[0], r[1]): r[2] for r in rows.groupBy("half", "label").count().collect()}
    if len({label for _, label in taken}) < 2:
        return flat
    weight = {(half, label): sizes[label] / total / n for (half, label), n in taken.items()}

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(2 * dims + 1)
        for batch in batches:
            x = _matrix(batch.column(0))
            w = np.array([weight[0, label] if half == 0 else 0.0 for label, half in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())])
            sums += np.concatenate([w @ x, w @ (x * x), [w.sum()]])
        yield pa.RecordBatch.from_arrays([pa.array([sums.tolist()])], names=["sums"])

    def added(f) -> np.ndarray:
        parts = [np.array(r[0]) for r in rows.mapInArrow(f, "sums array<double>").collect()]
        return np.sum(sorted(parts, key=lambda p: p.tobytes()), axis=0)

    sums = added(moments)
    mean = sums[:dims] / max(sums[-1], 1e-12)
    spread = np.sqrt(np.maximum(sums[dims : 2 * dims] / max(sums[-1], 1e-12) - mean**2, 1e-8))
    model = Model(mean, spread, flat.directions, flat.shifts, flat.weights, flat.edges, flat.values)
    size = FEATURES + 1

    def equations(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        left, right = np.zeros((size, size)), np.zeros(size)
        for batch in batches:
            y = batch.column(1).to_numpy().astype(np.float64)
            w = np.array([weight[0, label] if half == 0 else 0.0 for label, half in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())])
            z = model.features(_matrix(batch.column(0)))
            left += (z * w[:, None]).T @ z
            right += z.T @ (w * y)
        yield pa.RecordBatch.from_arrays([pa.array([np.concatenate([left.ravel(), right]).tolist()])], names=["sums"])

    sums = added(equations)
    left, right = sums[: size * size].reshape(size, size), sums[size * size :]
    model.weights = np.linalg.solve(left + RIDGE * np.trace(left) / size * np.eye(size), right)

    def margins(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = model.features(_matrix(batch.column(0))) @ model.weights
            yield pa.RecordBatch.from_arrays([pa.array(raw), batch.column(1), batch.column(2)], names=["raw", "label", "half"])

    got = rows.mapInArrow(margins, "raw double, label int, half int").filter("half = 1").toArrow()
    if got.num_rows:
        label = got.column("label").to_numpy()
        model.edges, model.values = isotonic(got.column("raw").to_numpy(), label.astype(np.float64), np.array([weight[1, x] for x in label.tolist()]))
    return model


def score(docs: DataFrame, model: Model, folds: int = 5, held: int = 0, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, held_out boolean, score double, predicted int) for every row of docs, in one pass without a shuffle.

    Null and empty texts have the statistics of an empty one. held_out is false for a null id. Repeated rows stay.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # of fixed size, under 1 MB

    def make():
        m = shared.value
        return lambda ids, texts: [ids, m.scores(texts)]

    scored = map_texts(docs, [("doc_id", id_type(docs, id_col)), ("score", T.DoubleType())], make, id_col, text_col)
    return scored.select("doc_id", F.coalesce(fold("doc_id", folds) == held, F.lit(False)).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
