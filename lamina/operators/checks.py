"""Constraints that a table must hold, as assertions over the finished rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class ConstraintError(ValueError):
    """A table breaks a key or holds a null where none may be."""


def require_unique(df: DataFrame, keys: Sequence[str], name: str = "table", nulls_distinct: bool = False) -> DataFrame:
    """df, or an error if a key occurs twice. Null parts are equal unless nulls_distinct."""
    rows = df.dropna(subset=list(keys)) if nulls_distinct else df
    twice = rows.groupBy(*keys).count().filter("count > 1").limit(3).collect()
    if twice:
        raise ConstraintError(f"{name}: {', '.join(keys)} not unique: {[tuple(r)[:-1] for r in twice]}")
    return df


def require_not_null(df: DataFrame, columns: Sequence[str], name: str = "table") -> DataFrame:
    """df, or an error if one of the columns holds a null; all are counted in one pass."""
    if columns:
        counts = df.agg(*[F.count(F.when(F.col(c).isNull(), 1)).alias(c) for c in columns]).first()
        bad = [c for c in columns if counts[c]]
        if bad:
            raise ConstraintError(f"{name}: null in {', '.join(bad)}")
    return df


def require_values(df: DataFrame, column: str, values: Sequence[str], name: str = "table") -> DataFrame:
    """df, or an error if the column holds anything else than the values or null."""
    odd = df.filter(~F.col(column).isin(*values)).select(column).limit(1).collect()
    if odd:
        raise ConstraintError(f"{name}: {column} holds {odd[0][0]!r}")
    return df
