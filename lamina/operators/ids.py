"""Dense row numbers without gathering the rows in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lamina.checkpoints import cut

_IN_TASK = (1 << 33) - 1


def numbered(df: DataFrame, order: Sequence[Column], name: str, start: int = 1, keep: Sequence[str] | None = None) -> DataFrame:
    """df, or its columns of keep, with numbers from start in the order, which should not tie.

    Rows are dealt out by ranges of the order; each range's first number is the sum of the counts before it, a table of one
    row per range. The placed rows are checkpointed before they are counted, so a lost executor can't give a row another
    place than it was counted at.
    """
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = cut(ranged.select(*(df.columns if keep is None else keep), F.spark_partition_id().alias("_range"), F.monotonically_increasing_id().bitwiseAND(_IN_TASK).alias("_at")))
    sizes = placed.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"))
    before = sizes.select("_range", (F.coalesce(F.sum("_n").over(W.orderBy("_range").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))).alias("_before"))
    return placed.join(F.broadcast(before), "_range").withColumn(name, F.col("_before") + F.col("_at") + F.lit(start)).drop("_range", "_at", "_before")


def renumbered(df: DataFrame, old: DataFrame | None, key: Sequence[str], name: str) -> DataFrame:
    """df with numbers: those that its keys have in an older version, and the next ones, in the order of the keys, for new keys.

    Keys are unique and null parts of them equal. A reload so leaves the numbers that other tables refer to as they are. Without an older version all
    numbers are new, from 1 on; numbers of keys that are gone are given again only if they were the greatest.
    """
    order = [F.col(k).asc_nulls_first() for k in key]
    if old is None or name not in old.columns:
        return numbered(df, order, name)
    known = old.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(key)], name)
    found = cut(df.join(known, [df[k].eqNullSafe(known[f"_k{i}"]) for i, k in enumerate(key)], "left").select(*df.columns, name))
    top = old.agg(F.max(name)).first()[0] or 0
    return found.filter(F.col(name).isNotNull()).unionByName(numbered(found.filter(F.col(name).isNull()).drop(name), order, name, top + 1))
