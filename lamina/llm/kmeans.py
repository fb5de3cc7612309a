"""Centroid clustering in exact integers: k-means whose assignment is sort-means (Phillips, 2002)."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lamina.llm.store import cut

CENTROIDS, ROUNDS, DIMS, SCALE, SEED = 8, 10, 64, 1024, 3
#: Rounds whose assignments a task works out again from the last written ones, rather than all rows being written each round.
STRIDE = 5
#: Vectors shorter than this in integer units take part: 4 * distance**2 then fits 64 bits.
LONGEST = 2.0**29
#: Vectors whose distances are worked out at a time.
BATCH = 4096


def squares(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    away = x - c
    return np.einsum("ij,ij->i", away, away)


def assign(x: np.ndarray, start: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest centroid of each vector, ties to the smaller number, and the squared distance.

    start: the centroid where each vector's scan begins, as a rule its last one. Others are scanned in order of their distance
    from that one; the scan of a vector ends where this distance is strictly beyond twice its own from the start, for a
    centroid that far off can neither be nearer nor as near (the triangle inequality), and no later one can.
    """
    best, least = start.copy(), np.zeros(len(x), dtype=np.int64)
    for c in np.unique(start):
        rows = np.flatnonzero(start == c)
        own = squares(x[rows], centres[c])
        near, at = own.copy(), np.full(len(rows), c, dtype=start.dtype)
        between = squares(centres, centres[c])
        active = np.arange(len(rows))
        for other in np.argsort(between, kind="stable"):
            if other == c:
                continue
            active = active[between[other] <= 4 * own[active]]
            if not len(active):
                break
            d = squares(x[rows[active]], centres[other])
            better = (d < near[active]) | ((d == near[active]) & (other < at[active]))
            near[active[better]], at[active[better]] = d[better], other
        best[rows], least[rows] = at, near
    return best, least


def replay(x: np.ndarray, start: np.ndarray, history: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The assignment after the rounds whose centroids history lists, each round begun from the one before."""
    distance = np.zeros(len(x), dtype=np.int64)
    for centres in history:
        start, distance = assign(x, start, centres)
    return start, distance


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(column), dims)


def _assigned(points: DataFrame, dims: int, history: list[np.ndarray], vectors: bool) -> DataFrame:
    """The points with their present cluster, and their vectors or their distances."""
    shared = points.sparkSession.sparkContext.broadcast(history)  # STRIDE times k centroids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, BATCH):
                part = batch.slice(at, BATCH)
                cluster, distance = replay(_matrix(part.column(1), dims), part.column(2).to_numpy(), shared.value)
                last = part.column(1) if vectors else pa.array(distance)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(cluster), last], names=["id", "cluster", "last"])

    kind = points.schema["id"].dataType.simpleString()
    made = points.select("id", "v", "cluster").mapInArrow(run, f"id {kind}, cluster int, last {'array<long>' if vectors else 'long'}")
    return made.select("id", F.col("last").alias("v"), "cluster") if vectors else made.withColumnRenamed("last", "distance")


def _sums(points: DataFrame, dims: int, history: list[np.ndarray]) -> dict[int, tuple[int, list[int]]]:
    """Rows and componentwise sums of each cluster. A task sums its own first: k * dims rows leave it, k * dims reach the driver."""
    shared = points.sparkSession.sparkContext.broadcast(history)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k, part_rows = len(shared.value[0]), 1 << 20  # so many vectors of LONGEST / 2**29 sum up within 64 bits
        totals, counts, held = np.zeros((k, dims), np.int64), np.zeros(k, np.int64), 0

        def made() -> pa.RecordBatch:
            used = np.flatnonzero(counts)
            return pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(counts[used]), pa.array(totals[used].tolist(), pa.list_(pa.int64()))], names=["cluster", "n", "total"])

        for batch in batches:
            for at in range(0, batch.num_rows, BATCH):
                part = batch.slice(at, BATCH)
                x = _matrix(part.column(0), dims)
                cluster, _ = replay(x, part.column(1).to_numpy(), shared.value)
                for c in np.unique(cluster):
                    totals[c] += x[cluster == c].sum(axis=0)
                counts += np.bincount(cluster, minlength=k)
                held += part.num_rows
                if held >= part_rows:
                    yield made()
                    totals[:], counts[:], held = 0, 0, 0
        if held:
            yield made()

    parts = points.select("v", "cluster").mapInArrow(run, "cluster int, n long, total array<long>")
    flat = parts.select("cluster", "n", F.posexplode("total").alias("place", "x"))
    rows = flat.groupBy("cluster", "place").agg(F.sum("n").alias("n"), F.sum(F.col("x").cast("decimal(38,0)")).alias("x")).collect()
    out: dict[int, tuple[int, list[int]]] = {}
    for cluster, place, n, x in rows:
        out.setdefault(cluster, (n, [0] * dims))[1][place] = int(x)
    return out


def kept(vectors: DataFrame, dims: int, scale: int, id_col: str, vector_col: str) -> DataFrame:
    """(id, v) with v in whole units, of the rows that take part."""
    own = vectors.select(F.col(id_col).alias("id"), F.col(vector_col).cast("array<double>").alias("x"))
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    own = own.filter((F.size("x") == dims) & ~F.exists("x", bad)).select("id", F.transform("x", lambda x: F.floor(x * F.lit(float(scale)))).alias("v"))
    return own.filter(F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))) < LONGEST)


def cluster(vectors: DataFrame, k: int = CENTROIDS, rounds: int = ROUNDS, dims: int = DIMS, scale: int = SCALE, seed: int = SEED, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(vec_id, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256) for each vector kept.

    Components become floor(scale * x); centroids start as the k kept vectors of the smallest sha256 of "seed:id", in that order,
    and move to the floor of their vectors' means; an empty one stays. distance is squared; inertias are its sums over the
    cluster and over all; centroid_sha256 is the digest of the final centroid's components, joined by commas. All is exact.

    Each round is one pass over the vectors that leaves sums only. Every STRIDE rounds the assignments are written to the shared
    folder; in between, a task works them out anew from the last written ones and the centroids since, which costs less than
    writing all vectors.

    Kept are vectors with exactly dims components, none null or non-finite, and of a length under 2**29 units, which no 64-bit
    distance needs more than. Of fewer than k kept vectors each starts a centroid; an empty table gives no rows. Rows of one id
    count each, and are told apart by their components where they start; null ids come last there, and stay in the result. Other columns
    are not read.
    """
    spark = vectors.sparkSession
    points = cut(kept(vectors, dims, scale, id_col, vector_col).withColumn("cluster", F.lit(0)))
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256)
    first = points.orderBy(digest.asc_nulls_last(), "v").limit(k).select("v").collect()
    if not first:
        kind = points.schema["id"].dataType.simpleString()
        return spark.createDataFrame([], f"vec_id {kind}, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string")
    centres = np.array([r[0] for r in first], dtype=np.int64)
    history: list[np.ndarray] = []
    for _ in range(rounds):
        if len(history) == STRIDE:
            points, history = cut(_assigned(points, dims, history, True)), []
        history.append(centres)
        centres = centres.copy()
        for c, (n, total) in _sums(points, dims, history).items():
            centres[c] = [x // n for x in total]
    done = cut(_assigned(points, dims, [*history, centres], False))
    inertia = {c: int(x) for c, x in done.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)"))).collect()}  # k rows
    facts = [(c, inertia[c], sum(inertia.values()), hashlib.sha256(",".join(map(str, centres[c].tolist())).encode()).hexdigest()) for c in sorted(inertia)]
    facts = F.broadcast(spark.createDataFrame(facts, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string"))  # k rows
    return done.join(facts, "cluster").select(F.col("id").alias("vec_id"), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
