"""Parquet exports of what a run wrote, in folders by stage, feed, table and day."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass, replace
from datetime import UTC, datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lamina.sources.labels import feed_name


@dataclass(frozen=True)
class Export:
    """Where one run exports to; an empty folder turns exports off."""

    folder: str
    stage: str
    run_id: str
    run_date: str

    @classmethod
    def start(cls, folder: str, stage: str = "") -> Export:
        now = datetime.now(UTC)
        return cls(folder, stage, f"{now:%Y%m%dT%H%M%SZ}-{uuid.uuid4().hex[:8]}", f"{now:%Y-%m-%d}")

    def for_stage(self, stage: str) -> Export:
        return replace(self, stage=stage)


def as_text(df: DataFrame) -> DataFrame:
    """Nested columns as JSON text, for a file of plain columns."""
    nested = (T.StructType, T.ArrayType, T.MapType, T.VariantType)
    return df.withColumns({f.name: F.to_json(f.name) for f in df.schema if isinstance(f.dataType, nested)}) if any(isinstance(f.dataType, nested) for f in df.schema) else df


def export(df: DataFrame, table: str, to: Export, feed: str | None = None) -> str | None:
    """Writes <folder>/<stage>/<feed>/<table>/run_date=<day>/<run>.parquet; None if exports are off or there are no rows."""
    if not to.folder or df.isEmpty():
        return None
    path = "/".join(filter(None, [to.folder, to.stage, feed_name(feed), table, f"run_date={to.run_date}", f"{to.run_id}.parquet"]))
    as_text(df).write.option("compression", "snappy").parquet(path)
    return path


#: Exporters of stages under all their spellings; stages without one of their own use export().
STAGES: dict[str, Callable] = {f"stage{sep}{n}": export for n in (3, 4, 5) for sep in ("", "_")}


def export_for_stage(df: DataFrame, table: str, to: Export, feed: str | None = None) -> str | None:
    return STAGES.get(to.stage.lower(), export)(df, table, to, feed)


def export_raw(df: DataFrame, table: str, feed: str, folder: str, run_id: str) -> str | None:
    """Writes all routed rows, repeated ones too: <folder>/<feed>/<table>/ingest_date=<day>/<run>.parquet."""
    if not folder or df.isEmpty():
        return None
    path = f"{folder}/{feed}/{table}/ingest_date={datetime.now(UTC):%Y-%m-%d}/{run_id}.parquet"
    as_text(df).write.option("compression", "snappy").parquet(path)
    return path
