"""Bounded, repeatable samples of labelled documents."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def fold(id_col: str, folds: int):
    """crc32 of the id as text, modulo folds; null for a null id."""
    return F.crc32(F.col(id_col).cast("string")) % folds


def sample(docs: DataFrame, labels: DataFrame, target: str, folds: int, held: int, most: int, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, dict[int, int]]:
    """(text, label, half) of at most so many labelled documents of each class outside the held fold; and the classes' sizes.

    Rows are taken in the order of a hash of their id, so the sample is the same each time. An id with several labels has
    the greatest, and one with several documents gives the text of the smallest hash, so there is a row for an id at most;
    labels that are neither 0 nor 1, and null ids, are left out. half: 0 or 1, by the hash. The ids are at most 2 * most
    rows, so they go to the documents as a broadcast.
    """
    marked = labels.select(F.col(id_col).alias("key"), F.col(target).cast("int").alias("label")).filter("key IS NOT NULL AND label IN (0, 1)")
    marked = marked.groupBy("key").agg(F.max("label").alias("label")).filter(F.crc32(F.col("key").cast("string")) % folds != held)
    sizes = {int(r[0]): int(r[1]) for r in marked.groupBy("label").count().collect()}
    order = F.xxhash64(F.col("key").cast("string"), F.lit(target))
    picked = None
    for value in (0, 1):
        some = marked.filter(F.col("label") == value).orderBy(order, "key").limit(most)
        picked = some if picked is None else picked.unionByName(some)
    picked = picked.withColumn("half", F.pmod(F.xxhash64("key", F.lit("half")), F.lit(2)).cast("int"))
    texts = docs.select(F.col(id_col).alias("key"), F.col(text_col).cast("string").alias("text"))
    met = texts.join(F.broadcast(picked), "key")
    first = W.partitionBy("key").orderBy(F.xxhash64("text"), "text")  # a row for each task and key goes on
    return met.withColumn("place", F.row_number().over(first)).filter("place = 1").select("text", "label", "half"), sizes
