"""The latest row per key, and rows of distinct content."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def newest(name: str | Column) -> Column:
    """Descending with nulls first: a row that was never dated counts as the newest."""
    return (F.col(name) if isinstance(name, str) else name).desc_nulls_first()


def newest_dated(name: str | Column) -> Column:
    """Descending with nulls last."""
    return (F.col(name) if isinstance(name, str) else name).desc_nulls_last()


def latest_by(df: DataFrame, keys: Sequence[str | Column], order: Sequence[Column]) -> DataFrame:
    """One row per key, the first in the order. Null keys are one key; add a tie-break where the order may tie.

    Catalyst keeps one row per key in each task before the shuffle, so a hot key costs one row a task.
    """
    rank = F.row_number().over(W.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).filter("_rank = 1").drop("_rank")


def distinct_content(df: DataFrame, hash_col: str = "hash_key", order: Sequence[Column] = ()) -> DataFrame:
    """The first row of each hash, by the order. Rows without a hash are all kept: null equals nothing. One pass over df."""
    order = list(order) or [F.col("bronze_row_id").asc_nulls_last()]
    alone = F.when(F.col(hash_col).isNull(), F.monotonically_increasing_id())  # a key of its own for each row without a hash
    return latest_by(df.withColumn("_alone", alone), [hash_col, "_alone"], order).drop("_alone")


def new_content(df: DataFrame, target: DataFrame | None, hash_col: str = "hash_key", order: Sequence[Column] = ()) -> DataFrame:
    """Rows of distinct content whose hash the target lacks; only the target's hashes are read."""
    once = distinct_content(df, hash_col, order)
    return once if target is None else once.join(target.select(hash_col), hash_col, "left_anti").select(*df.columns)


def upsert(target: DataFrame | None, delta: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The target with delta's rows in place of those of equal keys; null key parts are equal. Delta's keys are unique."""
    if target is None:
        return delta
    same = [target[k].eqNullSafe(delta[k]) for k in keys]
    return target.join(delta.select(*keys), same, "left_anti").unionByName(delta, allowMissingColumns=True)
