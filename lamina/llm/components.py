"""Connected components by alternating large-star and small-star rounds (Kiveris and others, 2014)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lamina.llm.store import cut, small_or_not


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node goes to the node's smallest neighbour or itself."""
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("least"))
    return both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b")).filter("a <> b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node, go to the smallest. Edges come as (larger, smaller)."""
    least = edges.groupBy("a").agg(F.min("b").alias("least"))
    joined = edges.join(least, "a")
    moved = joined.select(F.col("b").alias("a"), F.col("least").alias("b")).filter("a <> b")
    return moved.unionByName(least.select("a", F.col("least").alias("b"))).distinct()


def _digest(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the edges (a, b): root is the smallest node reachable.

    Only aggregates with partial sums and joins that can be split touch a node's edges, so a node of very many
    neighbours lands in no single task. Rounds go on until nothing changes; each is kept in the checkpoint folder.
    Loops and repeated edges are allowed; null ends are ignored; no edges give no rows.
    """
    edges = edges.select("a", "b").filter("a IS NOT NULL AND b IS NOT NULL AND a <> b")
    edges = cut(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    before = _digest(edges)
    while before[0]:
        edges = cut(_small_star(_large_star(edges)))
        after = _digest(edges)
        if after == before:
            break
        before = after
    roots = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())


def keep_one(docs: DataFrame, rows: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """docs with one row of each group, with all their columns: the row of the smallest id, null last, then of the smallest text_key.

    rows: (doc_id, text_key, grp) for every row of docs; text_key is what xxhash64() gives for the text. Of repeated rows of
    one id and text one stays. Only keys of rows that go, or are repeated, meet the documents.
    """
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_key")).alias("first")
    marked = rows.join(small_or_not(cut(rows.groupBy("grp").agg(first))), "grp")
    stays = F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("text_key") == F.col("first.text_key"))
    keys = cut(marked.groupBy("doc_id", "text_key", stays.alias("stays")).agg(F.count(F.lit(1)).alias("n")).filter("NOT stays OR n > 1"))

    def same(keys: DataFrame):
        return docs[id_col].eqNullSafe(keys["doc_id"]) & (F.xxhash64(docs[text_col].cast("string")) == keys["text_key"])

    apart = small_or_not(keys.select("doc_id", "text_key"))
    alone = docs.join(apart, same(apart), "left_anti")
    repeated = keys.filter("stays").select("doc_id", "text_key")
    if repeated.isEmpty():
        return alone
    repeated = small_or_not(repeated)
    again, place = docs.join(repeated, same(repeated), "left_semi"), "_" + max(docs.columns, key=len)
    several = W.partitionBy(again[id_col], F.xxhash64(again[text_col].cast("string"))).orderBy(F.lit(1))
    return alone.unionByName(again.withColumn(place, F.row_number().over(several)).filter(F.col(place) == 1).drop(place))
