"""Feeds mapped onto shared models, and their union."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lamina.operators.latest import latest_by, newest_dated


def project_model(df: DataFrame, model: Mapping[str, str], mapping: Mapping[str, Column]) -> DataFrame:
    """The model's columns in its order and types (name to type); those without a mapping are null."""
    unknown = set(mapping) - set(model)
    if unknown:
        raise KeyError(f"not in the model: {sorted(unknown)}")
    return df.select(*[mapping.get(name, F.lit(None)).cast(kind).alias(name) for name, kind in model.items()])


def latest_in_model(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """One row per natural key: the last updated, then the last posted, undated ones last; ties by the row's content."""
    content = F.xxhash64(*df.columns)
    return latest_by(df, list(key), [newest_dated("update_date"), newest_dated("posted_date"), content.desc()])


def union_tagged(feeds: Mapping[str, DataFrame | None], tag: str = "source_type") -> DataFrame | None:
    """All rows of the feeds that are there, each with its feed's name in front; None if none is there."""
    parts = [df.select(F.lit(name).alias(tag), "*") for name, df in feeds.items() if df is not None]
    return reduce(lambda a, b: a.unionByName(b), parts) if parts else None
