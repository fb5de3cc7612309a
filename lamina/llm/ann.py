"""Approximate nearest neighbours by inner product: a hierarchical k-means tree, searched best bin first."""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lamina.llm.store import cut

NEIGHBOURS = 20
#: Vectors that the tree is fitted on: LEAF_SAMPLE for each leaf that the table asks for, within these bounds; and queries
#: that its visits are calibrated with.
SAMPLE, MOST_SAMPLE, LEAF_SAMPLE, CALIBRATION = 20_000, 200_000, 8, 256
BRANCHES, ROUNDS = 8, 8
#: Rows of a leaf that the tree aims at while the sample allows it, and at most while the sample may grow.
LEAF_ROWS, LARGE_LEAF_ROWS = 512, 32_768
#: Rows and components of the index, and queries, that one group of a task holds, at most.
SHARD_ROWS, SHARD_VALUES, QUERY_ROWS = 65_536, 8 << 20, 16_384
#: Groups that the index is dealt to, at least, if it has as many leaves.
SHARDS = 12
RECALL = 0.96
_SLACK = 1e-9


@dataclass
class Tree:
    """Inner nodes have centres of their children; child numbers from `leaf` on are leaves (less `leaf`).

    Vectors get one more component, sqrt(reach**2 - length**2), and queries a zero: then the nearest vector is the one of
    the largest inner product.
    """

    centres: list[np.ndarray]
    children: list[np.ndarray]
    leaves: int
    reach: float

    LEAF = 1 << 30

    def lifted(self, x: np.ndarray) -> np.ndarray:
        return np.concatenate([x, np.sqrt(np.maximum(self.reach**2 - (x * x).sum(axis=1, keepdims=True), 0))], axis=1)

    def assign(self, x: np.ndarray) -> np.ndarray:
        """The leaf of each vector, always down to the nearest child."""
        out, work, lifted = np.zeros(len(x), dtype=np.int32), [(0, np.arange(len(x)))], self.lifted(x)
        while work:
            node, rows = work.pop()
            if node >= self.LEAF:
                out[rows] = node - self.LEAF
            elif len(rows):
                near = nearest(lifted[rows], self.centres[node])
                work += [(int(child), rows[near == i]) for i, child in enumerate(self.children[node])]
        return out

    def order(self, query: np.ndarray, visits: int) -> list[int]:
        """The first leaves on a best-bin-first walk: the nearest bin not yet opened is opened next, wherever it hangs."""
        query, heap, found = np.append(query, 0.0), [(0.0, 0)], []
        while heap and len(found) < visits:
            _, node = heapq.heappop(heap)
            if node >= self.LEAF:
                found.append(node - self.LEAF)
            else:
                away = ((self.centres[node] - query) ** 2).sum(axis=1)
                for d, child in zip(away.tolist(), self.children[node].tolist()):
                    heapq.heappush(heap, (d, child))
        return found


def nearest(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return ((centres * centres).sum(axis=1)[None, :] - 2 * (x @ centres.T)).argmin(axis=1)


def k_means(x: np.ndarray, k: int, rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray]:
    """Centres of the groups that have rows, and each row's group."""
    centres = x[np.sort(rng.choice(len(x), k, replace=False))]
    for _ in range(ROUNDS):
        group = nearest(x, centres)
        used, group = np.unique(group, return_inverse=True)
        centres = np.stack([x[group == g].mean(axis=0) for g in range(len(used))])
    return centres, nearest(x, centres)


def fit(sample: np.ndarray, reach: float, leaf_rows: float, seed: int = 1) -> Tree:
    """A tree whose leaves have about leaf_rows rows of the sample."""
    rng, tree = np.random.default_rng(seed), Tree([], [], 0, reach)
    x = tree.lifted(sample)

    def grow(rows: np.ndarray) -> int:
        """The number of the node, or of the leaf, for these rows."""
        parts = []
        if len(rows) > leaf_rows:
            k = int(min(BRANCHES, max(2, np.ceil(len(rows) / leaf_rows))))
            centres, group = k_means(x[rows], k, rng)
            parts = [(centres[g], rows[group == g]) for g in range(len(centres)) if (group == g).any()]
        if len(parts) < 2 and tree.centres:
            tree.leaves += 1
            return Tree.LEAF + tree.leaves - 1
        if len(parts) < 2:
            parts = [(x[rows].mean(axis=0) if len(rows) else np.zeros(x.shape[1]), rows)]
        node = len(tree.centres)
        tree.centres.append(np.stack([c for c, _ in parts]))
        tree.children.append(np.zeros(len(parts), dtype=np.int64))
        for i, (_, own) in enumerate(parts):
            tree.children[node][i] = grow(own)
        return node

    grow(np.arange(len(x)))
    return tree


def matrix(column: pa.Array, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), dims)


def valid(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, v) of the rows that take part: id and vector and all its components there, finite, not all zero."""
    v = F.col("v")
    own = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v"))
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    return own.filter(F.col("id").isNotNull() & v.isNotNull() & ~F.exists(v, bad) & F.exists(v, lambda x: x != 0))


def best(scores: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows and columns of the count largest of each row, with all that come within rounding of them."""
    if scores.shape[1] > count:
        least = np.partition(scores, scores.shape[1] - count, axis=1)[:, scores.shape[1] - count]
        return np.nonzero(scores >= (least - _SLACK * (1 + np.abs(least)))[:, None])
    return np.nonzero(np.ones(scores.shape, dtype=bool))


def ranked(queries: np.ndarray, own: np.ndarray | None, ids: np.ndarray, rows: np.ndarray, x: np.ndarray, pairs: list[tuple[np.ndarray, np.ndarray]], count: int) -> tuple[np.ndarray, ...]:
    """Of pairs of a query and a candidate: the count best for each query, as (query, candidate, score), ties by id and row.

    own: the row of each query, which is no candidate of it. Scores are summed anew from the first component to the last,
    so equal vectors have equal scores wherever they are met.
    """
    q, r = (np.concatenate([p[i] for p in pairs]) for i in (0, 1)) if pairs else (np.zeros(0, np.int64), np.zeros(0, np.int64))
    if own is not None:
        other = own[q] != rows[r]
        q, r = q[other], r[other]
    score = np.concatenate([np.cumsum(queries[q[i : i + 16_384]] * x[r[i : i + 16_384]], axis=1)[:, -1] for i in range(0, len(q), 16_384)]) if len(q) else np.zeros(0)
    order = np.lexsort((rows[r], ids[r], -score, q))
    q, r, score = q[order], r[order], score[order]
    keep = np.arange(len(q)) - np.searchsorted(q, q, side="left") < count
    return q[keep], r[keep], score[keep]


def calibrate(index: DataFrame, tree: Tree, probe_rows: np.ndarray, probes: np.ndarray, count: int, recall: float) -> int:
    """The fewest leaf visits with which the probes' true neighbours, by brute force over all rows, are found to the share recall."""
    dims = probes.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 8192):
                part = batch.slice(at, 8192)
                rows, ids, leaf, x = part.column(0).to_numpy(), part.column(1).to_numpy(), part.column(2).to_numpy(), matrix(part.column(3), dims)
                q, r, s = ranked(probes, probe_rows, ids, rows, x, [best(probes @ x.T, count + 1)], count)
                yield pa.RecordBatch.from_arrays([pa.array(q.astype(np.int32)), pa.array(rows[r]), pa.array(ids[r]), pa.array(leaf[r]), pa.array(s)], names=["q", "row", "id", "leaf", "score"])

    found = index.select("row", "id", "leaf", "v").mapInArrow(run, "q int, row long, id long, leaf int, score double")
    place = F.row_number().over(W.partitionBy("q").orderBy(F.desc("score"), "id", "row"))
    true = found.withColumn("rank", place).filter(F.col("rank") <= count).select("q", "leaf").toArrow()  # CALIBRATION * count rows at most
    q, leaf = true.column("q").to_numpy(), true.column("leaf").to_numpy()
    visit = np.zeros(len(q), dtype=np.int64)
    for p in np.unique(q):
        at = {x: i + 1 for i, x in enumerate(tree.order(probes[p], tree.leaves))}
        visit[q == p] = [at[x] for x in leaf[q == p].tolist()]
    return int(np.quantile(visit, recall, method="higher")) if len(visit) else tree.leaves


@dataclass
class Deal:
    """How leaves are packed into shards, in the order of the tree.

    A leaf beyond a shard's size has several shards of its own, by a hash of the row; `first` and `parts` say which.
    """

    first: np.ndarray
    parts: np.ndarray
    shards: int

    @classmethod
    def of(cls, held: list[int], room: int) -> "Deal":
        first, parts, shard, filled = np.zeros(len(held), np.int64), np.ones(len(held), np.int64), 0, 0
        for leaf, size in enumerate(held):
            if filled and filled + size > room:
                shard, filled = shard + 1, 0
            first[leaf], parts[leaf] = shard, max(1, -(-size // room))
            filled += size
            if parts[leaf] > 1:
                shard, filled = shard + int(parts[leaf]), 0
        return cls(first, parts, shard + 1)


def blocks_of(wanted: dict[int, int], query_rows: int) -> dict[int, int]:
    """Blocks of queries of each shard that is asked for: more than one only where its queries are beyond query_rows.

    A shard's rows are copied once for each of its blocks. All copies together are at most the index, plus a shard's size
    over query_rows for each visit of a query: in proportion to rows and queries, not to their product.
    """
    return {shard: -(-n // query_rows) for shard, n in wanted.items()}


def search(vectors: DataFrame, every: int = 20, count: int = NEIGHBOURS, recall: float = RECALL, id_col: str = "vec_id", vector_col: str = "embedding", sample: int = SAMPLE) -> DataFrame:
    """(query_id, rank, vec_id, score) of the nearest found of each query, nearest first, ties to the smaller vec_id.

    Queries are the rows whose id is divisible by `every`; candidates all rows but the query's own. Nearness is the inner
    product in double precision. The tree is fitted on a sample of `sample` vectors, or LEAF_SAMPLE for each LARGE_LEAF_ROWS
    rows up to MOST_SAMPLE, but every row is put in its leaf; each query visits as many leaves, best bin first, as
    CALIBRATION queries need to find the share `recall` of their true neighbours.

    Rows are told apart by a number of their own: of rows with one id each is a candidate of the others, and a repeated
    query has its neighbours once for each of its rows. Of equal vectors only the count + 1 smallest by id are searched, for
    no query needs more, and equal queries are searched once, so a vector of very many rows makes no crowd. Queries meet a
    shard of leaves in an equi-join; only shards that very many queries ask for are copied, see blocks_of.

    Null ids, and vectors that are null, zero, of another length than most, or hold null or non-finite components take no
    part. With fewer candidates than count, all are returned; an empty table, or one without queries, gives no rows. Other
    columns are not read.
    """
    spark, schema = vectors.sparkSession, "query_id long, rank int, vec_id long, score double"
    rows = valid(vectors, id_col, vector_col)
    sizes = rows.groupBy(F.size("v").alias("dims")).agg(F.count(F.lit(1)).alias("n"), F.max(F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x))).alias("reach"))
    most = sizes.orderBy(F.desc("n"), "dims").first()
    if most is None:
        return spark.createDataFrame([], schema)
    dims, reach = int(most[0]), float(most[2])
    points = cut(rows.filter(F.size("v") == dims).select("id", F.monotonically_increasing_id().alias("row"), F.xxhash64("v").alias("hash"), "v"))
    same = W.partitionBy("hash", "v").orderBy("id", "row")
    few = points.withColumn("copy", F.row_number().over(same)).filter(F.col("copy") <= count + 1).select("row", "id", "v")
    # one row for each vector that is asked for: key is the number of one of its rows
    asking = points.filter(F.col("id") % every == 0)
    asked = cut(asking.groupBy("hash", "v").agg(F.min("row").alias("key")))

    taken = most[1] if most[1] <= sample else min(max(sample, LEAF_SAMPLE * int(most[1]) // LARGE_LEAF_ROWS), MOST_SAMPLE)
    picked = points.orderBy(F.xxhash64("id"), "id", "row").limit(int(taken)).select("v").toArrow()
    fitted = np.unique(np.concatenate([matrix(c, dims) for c in picked.column("v").chunks]), axis=0)
    tree = fit(fitted, reach * (1 + 1e-9), max(float(LEAF_SAMPLE), LEAF_ROWS * len(fitted) / int(most[1])))
    shared = spark.sparkContext.broadcast(tree)  # of at most taken / LEAF_SAMPLE leaves

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            leaf = shared.value.assign(matrix(batch.column(2), dims))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(leaf), batch.column(2)], names=["row", "id", "leaf", "v"])

    index = cut(few.mapInArrow(place, "row long, id long, leaf int, v array<double>"))
    probe = asked.orderBy("hash", "key").limit(CALIBRATION).select("key", "v").toArrow()
    if not probe.num_rows:
        return spark.createDataFrame([], schema)
    visits = calibrate(index, tree, probe.column("key").to_numpy(), np.concatenate([matrix(c, dims) for c in probe.column("v").chunks]), count, recall)

    held = [0] * tree.leaves
    for leaf, size in index.groupBy("leaf").count().collect():
        held[leaf] = size
    deal = Deal.of(held, int(min(SHARD_ROWS, max(1, SHARD_VALUES // dims), max(LEAF_ROWS, -(-sum(held) // SHARDS)))))
    first, parts = deal.first, deal.parts

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for i, x in enumerate(matrix(batch.column(1), dims)):
                goals: dict[int, list[int]] = {}
                for leaf in shared.value.order(x, visits):
                    for s in range(int(first[leaf]), int(first[leaf] + parts[leaf])):
                        goals.setdefault(s, []).append(leaf)
                out += [(i, s, leaves) for s, leaves in goals.items()]
            pick = pa.array([o[0] for o in out], pa.int32())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pick), pa.array([o[1] for o in out], pa.int32()), pa.array([o[2] for o in out], pa.list_(pa.int32())), batch.column(1).take(pick)], names=["key", "shard", "leaves", "v"])

    visiting = cut(asked.select("key", "v").mapInArrow(walk, "key long, shard int, leaves array<int>, v array<double>"))
    blocks = blocks_of({s: n for s, n in visiting.groupBy("shard").count().collect()}, QUERY_ROWS)  # a row for each shard
    leaves = spark.createDataFrame([(i, int(first[i]), int(parts[i])) for i in range(tree.leaves)], "leaf int, first long, parts long")
    shards = F.broadcast(spark.createDataFrame(sorted(blocks.items()), "shard int, blocks int"))  # SHARD_ROWS of the index make a row
    dealt = index.join(F.broadcast(leaves), "leaf").select("row", "id", "leaf", "v", (F.col("first") + F.pmod(F.xxhash64("row"), F.col("parts"))).cast("int").alias("shard"))
    dealt = dealt.join(shards, "shard").withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    visiting = visiting.join(shards, "shard").withColumn("block", F.pmod(F.xxhash64("key", F.lit(1)), F.col("blocks")).cast("int"))

    def meet(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return pa.table({"key": pa.array([], pa.int64()), "row": pa.array([], pa.int64()), "vec_id": pa.array([], pa.int64()), "score": pa.array([], pa.float64())})
        rows_, ids, leaf, keys = (t.column(c).to_numpy() for t, c in ((left, "row"), (left, "id"), (left, "leaf"), (right, "key")))
        x, q = (np.concatenate([matrix(c, dims) for c in t.column("v").chunks]) for t in (left, right))
        goals = right.column("leaves").combine_chunks()
        owner, wanted = np.repeat(np.arange(len(keys)), goals.value_lengths().to_numpy()), goals.flatten().to_numpy()
        by_leaf, by_goal = np.argsort(leaf, kind="stable"), np.argsort(wanted, kind="stable")
        out = []
        for some in range(0, len(keys), 512):  # so many queries' pairs are held at a time
            pairs = []
            mine = by_goal[(owner[by_goal] >= some) & (owner[by_goal] < some + 512)]
            for one in np.unique(wanted[mine]):
                here = by_leaf[np.searchsorted(leaf[by_leaf], one, "left") : np.searchsorted(leaf[by_leaf], one, "right")]
                those = owner[mine[np.searchsorted(wanted[mine], one, "left") : np.searchsorted(wanted[mine], one, "right")]]
                for j in range(0, len(here), 8192):
                    a, b = best(q[those] @ x[here[j : j + 8192]].T, count + 1)
                    pairs.append((those[a], here[j : j + 8192][b]))
            out.append(ranked(q, None, ids, rows_, x, pairs, count + 1))
        a, b, score = (np.concatenate([o[i] for o in out]) for i in range(3))
        return pa.table({"key": keys[a], "row": rows_[b], "vec_id": ids[b], "score": score})

    found = dealt.drop("blocks").groupBy("shard", "block").cogroup(visiting.drop("blocks").groupBy("shard", "block")).applyInArrow(meet, "key long, row long, vec_id long, score double")
    nearest_first = F.row_number().over(W.partitionBy("key").orderBy(F.desc("score"), "vec_id", "row"))
    top = found.withColumn("rank", nearest_first).filter(F.col("rank") <= count + 1)
    lists = top.groupBy("key").agg(F.array_sort(F.collect_list(F.struct("rank", "vec_id", "row", "score"))).alias("near"))
    # each row that asks has its vector's neighbours, less itself
    members = asking.join(asked, ["hash", "v"]).select("id", "row", "key")
    others = F.slice(F.filter("near", lambda x: x["row"] != F.col("row")), 1, count)
    return members.join(lists, "key").select(F.col("id").alias("query_id"), F.posexplode(others).alias("pos", "found")).select("query_id", (F.col("pos") + 1).cast("int").alias("rank"), "found.vec_id", "found.score")
