"""What is there and what could run, without writing anything."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lamina.operators.scope import MAPPING_SCHEMA
from lamina.plans.registry import RAW, Plan, Registry
from lamina.plans.runner import missing_sources, rows_of
from lamina.sources.feeds import BUSINESS, schema_of
from lamina.sources.tables import Tables


def inventory(tables: Tables, layers: tuple[str, ...]) -> DataFrame:
    """(layer, table_name, row_count) of every table of the layers, in order of name."""
    rows = [(layer, t, tables.read(layer, t).count()) for layer in layers for t in tables.list(layer)]
    return tables.spark.createDataFrame(rows, "layer string, table_name string, row_count long")


def readiness(registry: Registry, tables: Tables) -> list[tuple[str, str, list[str]]]:
    """(name, status, missing sources) of each plan: BLOCKED without its sources, SKIP if its table is there, else READY."""
    out = []
    for name in sorted(registry):
        plan = registry[name]
        missing = missing_sources(plan, tables)
        out.append((name, "BLOCKED" if missing else "SKIP" if tables.exists(plan.layer, plan.table) else "READY", missing))
    return out


@dataclass
class Empty:
    """Tables without rows: the raw ones by their schemas, all others by the plans that build them."""

    spark: SparkSession
    registry: Registry

    def exists(self, layer: str, table: str) -> bool:
        return (layer, table) in self._plans() or layer == RAW and (table in BUSINESS or table == "shipper_mapping")

    def _plans(self) -> dict[tuple[str, str], Plan]:
        return {(p.layer, p.table): p for p in self.registry.values()}

    def read(self, layer: str, table: str) -> DataFrame:
        if layer == RAW:
            return self.spark.createDataFrame([], MAPPING_SCHEMA if table == "shipper_mapping" else schema_of(table))
        plan = self._plans()[layer, table]
        rows = rows_of(plan, self)
        if plan.surrogate:
            rows = rows.select(F.lit(None).cast("long").alias(plan.surrogate), "*")
        return rows.withColumn(plan.stamp, F.current_timestamp()) if plan.stamp else rows


def explain(registry: Registry, tables: Tables, name: str) -> str:
    """A plan's sources, key, columns and Spark's plan of its rows, from empty sources where some are missing.

    An unknown name raises KeyError.
    """
    plan = registry[name]
    lines = [f"{plan.layer}.{plan.table} reads {', '.join('.'.join(s) for s in (*plan.sources, *plan.optional)) or 'nothing'}", f"key: {', '.join(plan.key) or 'none'}"]
    target = None if missing_sources(plan, tables) else rows_of(plan, tables)
    there = target is not None
    if not there:
        empty = Empty(tables.spark, registry)
        if unknown := [".".join(s) for s in plan.sources if not empty.exists(*s)]:
            return "\n".join([*lines, f"sources are missing whose columns are not known: {', '.join(unknown)}"])
        target = rows_of(plan, empty)
    whole = [(plan.surrogate, "bigint")] * bool(plan.surrogate) + [(f.name, f.dataType.simpleString()) for f in target.schema] + [(plan.stamp, "timestamp")] * bool(plan.stamp)
    lines.append("columns: " + ", ".join(f"{n} {t}" + " not null" * (n in plan.not_null) for n, t in whole))
    lines.append("" if there else "sources are missing: the plan is of empty ones")
    lines.append(target._jdf.queryExecution().toString())
    return "\n".join(filter(None, lines))
