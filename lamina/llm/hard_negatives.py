"""Hard negatives: rows of another label whose inner product with an anchor lies in a window below that of a positive.

A vantage-point tree (Yianilos, 1993) over vectors that one more component, sqrt(reach**2 - length**2), puts on a sphere. An anchor gets a
zero there; its length has no part in the order of its scores, so it lies on the sphere, too. The distance is the angle, whose cosine is
score / (|anchor| * reach), and a window of scores is an annulus around the anchor.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lamina.llm.ann import Deal, blocks_of
from lamina.llm.store import cut

POSITIVES, NEGATIVES, SCALE = 5, 10, 256
#: Per cent of the positive's score from which, and up to which, a negative is hard.
LOW, HIGH = 30, 90
#: Vectors that the tree is fitted on, and rows of a leaf that it aims at while the sample allows it.
SAMPLE, LEAF_ROWS, LEAF_SAMPLE = 20_000, 512, 8
#: Leaves that a first visit opens, to learn what the other leaves have to better.
FIRST = 4
#: Rows and components of the index, and probes, that one group of a task holds, at most; groups that the index is dealt to, at least.
SHARD_ROWS, SHARD_VALUES, PROBE_ROWS, SHARDS = 65_536, 8 << 20, 16_384, 12
#: Squared length in whole units below which vectors take part, so that nine times a score fits 64 bits.
LONGEST = 2.0**59
_FAR = 1 << 60


def angles(x: np.ndarray, point: np.ndarray) -> np.ndarray:
    """Between unit vectors, from their chords, which are exact where the angle is small."""
    away = x - point
    return 2 * np.arcsin(np.minimum(1.0, np.sqrt(np.einsum("ij,ij->i", away, away)) / 2))


@dataclass
class Tree:
    """Node i has a vantage point and two children, the rows nearer to it than the median and the others.

    A child from LEAF on is a leaf (less LEAF). bounds[i] has the least and the greatest distance from the vantage point of all
    rows of either child, also of those that the tree was not fitted on.
    """

    reach2: int
    points: list[np.ndarray] = field(default_factory=list)
    radius: list[float] = field(default_factory=list)
    children: list[list[int]] = field(default_factory=list)
    leaves: int = 0
    bounds: np.ndarray | None = None

    LEAF = 1 << 30

    #: More than any rounding of an angle.
    SLACK = 1e-6

    def lifted(self, x: np.ndarray) -> np.ndarray:
        """Unit vectors with one component more."""
        x = x.astype(np.float64) / self.reach2**0.5
        return np.concatenate([x, np.sqrt(np.maximum(1 - (x * x).sum(axis=1, keepdims=True), 0))], axis=1)

    def place(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The leaf of each vector, and for each node and child the least and greatest distance of the vectors that went there."""
        lifted, leaf = self.lifted(x), np.zeros(len(x), dtype=np.int32)
        seen = np.empty((len(self.points), 2, 2))
        seen[..., 0], seen[..., 1] = np.inf, -np.inf
        work = [(0, np.arange(len(x)))]
        while work:
            node, rows = work.pop()
            if not len(rows):
                continue
            if node >= self.LEAF:
                leaf[rows] = node - self.LEAF
                continue
            away = angles(lifted[rows], self.points[node])
            far = away > self.radius[node]
            for side, mine in enumerate((~far, far)):
                if mine.any():
                    seen[node, side] = away[mine].min(), away[mine].max()
                    work.append((self.children[node][side], rows[mine]))
        return leaf, seen

    def walk(self, anchor: np.ndarray, inner: float, outer: float) -> Iterator[int]:
        """Leaves that may hold rows at a distance between inner and outer, in the order of the least distance from inner on.

        Of nodes that begin equally near the one whose rows may reach less far out comes first, so one that straddles the inner circle closely goes
        before one that reaches through the whole annulus.
        """
        anchor = np.append(anchor.astype(np.float64), 0.0)
        length = np.linalg.norm(anchor)
        if not length:  # every row has score 0, wherever it lies
            length, inner, outer = 1.0, 0.0, math.pi
        anchor /= length
        heap: list[tuple[float, float, int, float]] = [(inner, np.inf, 0, 0.0)]
        while heap:
            least, most, node, low = heapq.heappop(heap)
            if node >= self.LEAF:
                yield node - self.LEAF
                continue
            away = float(angles(anchor[None, :], self.points[node])[0])
            for side, child in enumerate(self.children[node]):
                near, far = self.bounds[node, side]
                if near > far:
                    continue  # no row went there
                lower, upper = max(low, away - far, near - away), min(most, away + far)
                if lower <= outer + self.SLACK and upper >= inner - self.SLACK:
                    heapq.heappush(heap, (max(inner, lower), upper, child, lower))

    def circle(self, anchor: np.ndarray, score: int) -> float:
        """The distance of rows with this score from the anchor. Of a zero anchor all rows are equally far."""
        length = float(np.linalg.norm(anchor.astype(np.float64)))
        return math.acos(min(1.0, max(-1.0, score / (length * self.reach2**0.5)))) if length else math.pi / 2


def fit(sample: np.ndarray, reach2: int, leaf_rows: float, seed: int = 1) -> Tree:
    """A tree whose leaves have about leaf_rows rows of the sample. A vantage point is the row, of some, whose distances vary most."""
    rng, tree = np.random.default_rng(seed), Tree(reach2)
    x = tree.lifted(sample)

    def grow(rows: np.ndarray) -> int:
        if tree.points and len(rows) <= leaf_rows:
            tree.leaves += 1
            return Tree.LEAF + tree.leaves - 1
        best, radius, far = None, 0.0, None
        for pick in rng.choice(rows, min(8, len(rows)), replace=False):
            away = angles(x[rows], x[pick])
            if best is None or away.std() > best[0]:
                best, radius = (away.std(), pick), float(np.median(away))
                far = away > radius
        if tree.points and not far.any():
            tree.leaves += 1
            return Tree.LEAF + tree.leaves - 1
        node = len(tree.points)
        tree.points.append(x[best[1]])
        tree.radius.append(radius)
        tree.children.append([0, 0])
        for side, own in enumerate((rows[~far], rows[far])):
            tree.children[node][side] = grow(own)
        return node

    grow(np.arange(len(x)))
    return tree


def matrix(column: pa.Array | pa.ChunkedArray, dims: int) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(column), dims)


def highest(scores: np.ndarray, allowed: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows and columns of the count largest allowed scores of each row, with all that tie with the least of them."""
    if scores.shape[1] > count:
        shown = np.where(allowed, scores, -_FAR)
        least = np.partition(shown, shown.shape[1] - count, axis=1)[:, shown.shape[1] - count]
        allowed = allowed & (scores >= least[:, None])
    return np.nonzero(allowed)


def _found(count: int, same: bool, dims: int, exact: bool, id_kind: pa.DataType):
    """The join of a shard's rows with the probes that visit it: the best count of each probe."""

    def best(probe: np.ndarray, held: np.ndarray, scores: np.ndarray, ids: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, ...]:
        order = np.lexsort((rows[held], ids[held], -scores, probe))
        probe, held, scores = probe[order], held[order], scores[order]
        first = np.arange(len(probe)) - np.searchsorted(probe, probe, side="left") < count
        return probe[first], held[first], scores[first]

    def meet(left: pa.Table, right: pa.Table) -> pa.Table:
        out: list[tuple[np.ndarray, ...]] = []
        if left.num_rows and right.num_rows:
            leaf, label, ids, rows = (left.column(c).to_numpy() for c in ("leaf", "label", "id", "row"))
            x, q = matrix(left.column("v"), dims), matrix(right.column("v"), dims)
            if exact:  # products and sums below 2**53
                x, q = x.astype(np.float64), q.astype(np.float64)
            own, low, high, key, window = (right.column(c).to_numpy() for c in ("label", "bar", "high", "key", "window"))
            goals = right.column("leaves").combine_chunks()
            owner, wanted = np.repeat(np.arange(len(key)), goals.value_lengths().to_numpy()), goals.flatten().to_numpy()
            for one in np.unique(wanted):
                here = np.flatnonzero(leaf == one)
                those = owner[wanted == one]
                for some in range(0, len(those), 256):
                    ask = those[some : some + 256]
                    for j in range(0, len(here), 8192):
                        held = here[j : j + 8192]
                        scores = (q[ask] @ x[held].T).astype(np.int64)
                        allowed = ((label[held][None, :] == own[ask][:, None]) == same) & (scores >= low[ask][:, None]) & (scores <= high[ask][:, None])
                        a, b = highest(scores, allowed, count)
                        out.append(best(ask[a], held[b], scores[a, b], ids, rows))
            probe, held, scores = (np.concatenate([o[i] for o in out]) for i in range(3)) if out else (np.zeros(0, np.int64),) * 3
            probe, held, scores = best(probe, held, scores, ids, rows)  # of all leaves that a probe visits here
            return pa.table({"key": key[probe], "window": window[probe], "row": rows[held], "id": pa.array(ids[held], id_kind), "score": scores})
        nothing = pa.array([], pa.int64())
        return pa.table({"key": nothing, "window": nothing, "row": nothing, "id": pa.array([], id_kind), "score": nothing})

    return meet


class Index:
    """All rows in the leaves of a tree, and searches that are exact: a first visit of the nearest leaves says which of the others have to be visited."""

    def __init__(self, rows: DataFrame, dims: int, reach2: int, total: int, sample: int = SAMPLE):
        self.dims, self.exact = dims, reach2 < 1 << 53
        picked = rows.orderBy(F.xxhash64("id", "row"), "row").limit(sample).select("v").toArrow()
        fitted = np.unique(matrix(picked.column("v"), dims), axis=0)
        tree = fit(fitted, reach2, max(float(LEAF_SAMPLE), LEAF_ROWS * len(fitted) / max(total, 1)))
        shared = rows.sparkSession.sparkContext.broadcast(tree)  # of at most sample / LEAF_SAMPLE * 2 leaves

        def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                leaf = np.concatenate([shared.value.place(matrix(batch.column(3).slice(at, 4096), dims))[0] for at in range(0, batch.num_rows, 4096)]) if batch.num_rows else np.zeros(0, np.int32)
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(leaf)], names=["id", "row", "label", "v", "leaf"])

        def spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            all_seen = None
            for batch in batches:
                for at in range(0, batch.num_rows, 4096):
                    _, seen = shared.value.place(matrix(batch.column(0).slice(at, 4096), dims))
                    all_seen = seen if all_seen is None else np.stack([np.minimum(all_seen[..., 0], seen[..., 0]), np.maximum(all_seen[..., 1], seen[..., 1])], axis=-1)
            if all_seen is not None:
                node, side = np.nonzero(all_seen[..., 0] <= all_seen[..., 1])
                yield pa.RecordBatch.from_arrays([pa.array(node.astype(np.int32)), pa.array(side.astype(np.int32)), pa.array(all_seen[node, side, 0]), pa.array(all_seen[node, side, 1])], names=["node", "side", "near", "far"])

        kind = rows.schema["id"].dataType.simpleString()
        self.rows = cut(rows.select("id", "row", "label", "v").mapInArrow(place, f"id {kind}, row long, label long, v array<long>, leaf int"))
        tree.bounds = np.empty((len(tree.points), 2, 2))
        tree.bounds[..., 0], tree.bounds[..., 1] = np.inf, -np.inf
        found = self.rows.select("v").mapInArrow(spans, "node int, side int, near double, far double")
        for node, side, near, far in found.groupBy("node", "side").agg(F.min("near"), F.max("far")).collect():  # two rows for each node
            tree.bounds[node, side] = near, far
        self.tree = rows.sparkSession.sparkContext.broadcast(tree)
        held = [0] * tree.leaves
        for leaf, size in self.rows.groupBy("leaf").count().collect():
            held[leaf] = size
        self.deal = Deal.of(held, int(min(SHARD_ROWS, max(1, SHARD_VALUES // dims), max(LEAF_ROWS, -(-sum(held) // SHARDS)))))

    def _visits(self, probes: DataFrame, first: bool) -> DataFrame:
        """A row for each probe and shard it visits. probes: (key, window, label, v, low, high, bar); scores under bar help no more."""
        tree, deal, dims = self.tree, self.deal, self.dims

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            t = tree.value
            for batch in batches:
                pick, shard, leaves = [], [], []
                low, high, bar = (batch.column(c).to_pylist() for c in (4, 5, 6))
                for i, q in enumerate(matrix(batch.column(3), dims)):
                    inner, outer, needed = t.circle(q, high[i]), t.circle(q, low[i]), t.circle(q, bar[i])
                    goals: dict[int, list[int]] = {}
                    walk = t.walk(q, inner, outer)
                    opened = [leaf for _, leaf in zip(range(FIRST), walk)]
                    if not first:
                        before = set(opened)
                        opened = [leaf for leaf in t.walk(q, inner, needed) if leaf not in before]
                    for leaf in opened:
                        for s in range(int(deal.first[leaf]), int(deal.first[leaf] + deal.parts[leaf])):
                            goals.setdefault(s, []).append(leaf)
                    for s, those in goals.items():
                        pick.append(i)
                        shard.append(s)
                        leaves.append(those)
                rows = pa.array(pick, pa.int32())
                columns = [batch.column(c).take(rows) for c in (0, 1, 2, 3, 5, 6)]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(shard, pa.int32()), pa.array(leaves, pa.list_(pa.int32()))], names=["key", "window", "label", "v", "high", "bar", "shard", "leaves"])

        spark = probes.sparkSession
        tasks = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
        own = probes.select("key", "window", "label", "v", "low", "high", "bar").repartition(tasks)  # few bytes, but long walks
        return cut(own.mapInArrow(run, "key long, window long, label long, v array<long>, high long, bar long, shard int, leaves array<int>"))

    def _meet(self, visits: DataFrame, count: int, same: bool) -> DataFrame:
        spark, first, parts = visits.sparkSession, self.deal.first, self.deal.parts
        blocks = blocks_of({s: n for s, n in visits.groupBy("shard").count().collect()}, PROBE_ROWS)  # a row for each shard
        leaves = spark.createDataFrame([(i, int(first[i]), int(parts[i])) for i in range(len(first))], "leaf int, first long, parts long")
        shards = F.broadcast(spark.createDataFrame(sorted(blocks.items()), "shard int, blocks int"))  # SHARD_ROWS of the index make a row
        dealt = self.rows.join(F.broadcast(leaves), "leaf").select("row", "id", "label", "leaf", "v", (F.col("first") + F.pmod(F.xxhash64("row"), F.col("parts"))).cast("int").alias("shard"))
        dealt = dealt.join(shards, "shard").withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).drop("blocks")
        asking = visits.join(shards, "shard").withColumn("block", F.pmod(F.xxhash64("key", "window"), F.col("blocks")).cast("int")).drop("blocks")
        kind = self.rows.schema["id"].dataType
        from pyspark.sql.pandas.types import to_arrow_type

        meet = _found(count, same, self.dims, self.exact, to_arrow_type(kind))
        return dealt.groupBy("shard", "block").cogroup(asking.groupBy("shard", "block")).applyInArrow(meet, f"key long, window long, row long, id {kind.simpleString()}, score long")

    def search(self, probes: DataFrame, count: int, same: bool) -> DataFrame:
        """(key, window, rank, row, id, score): of each probe (key, window, label, v, low, high) the first count rows of its label, or of others, with scores from low to high."""
        place = F.row_number().over(W.partitionBy("key", "window").orderBy(F.desc("score"), "id", "row"))
        probes = cut(probes)
        begun = cut(self._meet(self._visits(probes.withColumn("bar", F.col("low")), True), count, same).withColumn("rank", place).filter(F.col("rank") <= count))
        full = begun.filter(F.col("rank") == count).select("key", "window", F.col("score").alias("least"))
        going = probes.join(full, ["key", "window"], "left").withColumn("bar", F.coalesce("least", "low"))
        rest = self._meet(self._visits(going, False), count, same)
        return begun.drop("rank").unionByName(rest).withColumn("rank", place).filter(F.col("rank") <= count)


def kept(vectors: DataFrame, scale: int, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    """(id, label, v) with v in whole units, of the rows that take part, whatever their vectors' length."""
    own = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"), F.col(vector_col).cast("array<double>").alias("x"))
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    own = own.filter("id IS NOT NULL AND label IS NOT NULL AND x IS NOT NULL").filter(~F.exists("x", bad))
    own = own.select("id", "label", F.transform("x", lambda x: F.floor(x * F.lit(float(scale)))).alias("v"))
    return own.withColumn("length", F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))).filter(F.col("length") < LONGEST)


def mine(
    vectors: DataFrame, anchor: Column | None = None, positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH, scale: int = SCALE,
    id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", sample: int = SAMPLE,
) -> DataFrame:
    """(anchor_id, positive_id, rank int, negative_id, positive_score, negative_score) for each anchor and each of its positives.

    anchor: a condition on the column `id`, by default that it is divisible by 100. Components become floor(scale * x); a score is the exact inner product
    with the anchor; higher scores come first, ties by the smaller id. Positives are an anchor's first rows of its label but itself; negatives of
    one the first rows of other labels with low * positive <= 100 * negative <= high * positive. Of a score below zero that is none.

    The tree is fitted on at most `sample` rows; every row is put in its leaf, and the leaf's true bounds are taken over all rows. A search walks
    the tree nearest first within the annulus, first to FIRST leaves, then, if these hold fewer rows than wanted or farther ones, to all others that may hold as near ones: the
    result is exact. Of equal vectors of one label only those are searched that can be among the first, and equal anchors search once.

    Rows are told apart by a number of their own: of rows with one id each is a candidate of the others, and a repeated anchor has its rows once
    for each. Null ids, labels and vectors, null and non-finite components, vectors of another size than most, and those of a squared length
    of 2**59 units or more take no part. An empty table, or one without anchors, gives no rows. Other columns are not read.
    """
    spark, schema = vectors.sparkSession, "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    rows = kept(vectors, scale, id_col, vector_col, label_col)
    most = rows.groupBy(F.size("v").alias("dims")).agg(F.count(F.lit(1)).alias("n"), F.max("length").alias("length")).orderBy(F.desc("n"), "dims").first()
    if most is None or not most[0]:
        return spark.createDataFrame([], schema)
    dims, reach2 = int(most[0]), int(most[2] * (1 + 1e-12)) + 1
    points = cut(rows.filter(F.size("v") == dims).select("id", F.monotonically_increasing_id().alias("row"), "label", F.xxhash64("v").alias("hash"), "v"))
    copies = W.partitionBy("label", "hash", "v").orderBy("id", "row")
    few = points.withColumn("copy", F.row_number().over(copies)).filter(F.col("copy") <= max(negatives, positives + 1)).drop("copy", "hash")
    members = points.filter(F.col("id") % 100 == 0 if anchor is None else anchor)
    asked = cut(members.groupBy("label", "hash", "v").agg(F.min("row").alias("key")))
    if asked.isEmpty():
        return spark.createDataFrame([], schema)
    index = Index(few, dims, reach2, int(most[1]), sample)

    limits = {"low": F.lit(-_FAR).cast("long"), "high": F.lit(_FAR).cast("long")}
    near = cut(index.search(asked.select("key", F.lit(0).cast("long").alias("window"), "label", "v").withColumns(limits), positives + 1, True))
    ratio = T.DecimalType(20, 0)
    score, hundred = F.col("score").cast(ratio), 100
    probes = near.filter("score >= 0").select("key", "score").distinct().join(asked.select("key", "label", "v"), "key")
    probes = probes.select("key", F.col("score").alias("window"), "label", "v", F.floor((score * low + (hundred - 1)) / hundred).cast("long").alias("low"), F.floor(score * high / hundred).cast("long").alias("high"))
    hard = index.search(probes.filter("low <= high"), negatives, False)

    lists = near.groupBy("key").agg(F.array_sort(F.collect_list(F.struct("rank", "id", "row", "score"))).alias("near"))
    others = F.slice(F.filter("near", lambda x: x["row"] != F.col("row")), 1, positives)
    pairs = members.join(asked, ["label", "hash", "v"]).select("id", "row", "key").join(lists, "key").select("key", F.col("id").alias("anchor_id"), F.explode(others).alias("p"))
    pairs = pairs.select("key", "anchor_id", F.col("p.id").alias("positive_id"), F.col("p.score").alias("window"))
    found = pairs.join(hard.select("key", "window", "rank", F.col("id").alias("negative_id"), F.col("score").alias("negative_score")), ["key", "window"])
    return found.select("anchor_id", "positive_id", "rank", "negative_id", F.col("window").alias("positive_score"), "negative_score")
