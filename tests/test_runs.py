"""Runs of many tables: each when its sources are there, at once where they don't depend on each other, with numbers that stay."""

from __future__ import annotations

import threading

import pytest
from pyspark.sql import functions as F

from lamina.operators.ids import renumbered
from lamina.plans.registry import Plan, Registry
from lamina.plans.runner import run_many
from lamina.sources.tables import Tables


@pytest.fixture
def tables(spark, tmp_path):
    return Tables(spark, str(tmp_path / "data"))


def registry(spark, log: list, broken: str = "") -> Registry:
    """a and b read nothing, c reads a, d reads b and c."""
    out = Registry()
    reads = {"a": (), "b": (), "c": ("a",), "d": ("b", "c")}
    together = threading.Barrier(2)

    def build(name):
        def f(there):
            log.append(("begin", name))
            if name in ("a", "b"):
                together.wait(30)  # both are built at a time
            if name == broken:
                raise ValueError("broken")
            rows = [there[x] for x in reads[name]]
            log.append(("end", name))
            return spark.range(3).withColumn("n", F.lit(sum(r.count() for r in rows)))

        return f

    for name, sources in reads.items():
        out.register(Plan(name, "x", name, "firm", "g", tuple(("x", s) for s in sources), build(name), key=("id",)))
    return out


def test_tables_are_built_when_their_sources_are_there(spark, tables):
    log: list = []
    done = run_many(registry(spark, log), tables)
    assert [(r.name, r.status, r.rows) for r in done] == [(n, "succeeded", 3) for n in "abcd"]
    assert log.index(("end", "a")) < log.index(("begin", "c")) and log.index(("end", "c")) < log.index(("begin", "d"))
    assert tables.read("x", "d").first().n == 6
    assert [r.status for r in run_many(registry(spark, log), tables)] == ["skipped"] * 4  # a lost run goes on from what is there


def test_what_reads_a_failed_table_is_skipped(spark, tables):
    done = run_many(registry(spark, [], "a"), tables)
    assert {r.name: r.status for r in done} == {"a": "failed", "b": "succeeded", "c": "skipped", "d": "skipped"}


def test_a_bad_cell_loses_its_row_only(spark, tables):
    spark.createDataFrame([(1, "5", "2024-01-01"), (2, "x", "never"), (3, "", None), (4, "7.5", "2024-01-02T00:00:00Z")], "bronze_row_id long, q string, t string").write.parquet(tables.folder("x", "raw"))
    plans = Registry()
    build = lambda t: t["raw"].select("bronze_row_id", F.nullif("q", F.lit("")).cast("decimal(38,10)").alias("q"), F.col("t").cast("timestamp").alias("t"))
    plans.register(Plan("p", "x", "p", "firm", "g", (("x", "raw"),), build, key=("bronze_row_id",), casts={"raw": {"q": "decimal(38,10)", "t": "timestamp"}}))
    assert [(r.status, r.rows) for r in run_many(plans, tables)] == [("succeeded", 3)]
    assert sorted(r.bronze_row_id for r in tables.read("x", "p").collect()) == [1, 3, 4]
    listed = tables.read("rejected", "p").select("source", "bronze_row_id", "column", "value", "reason").collect()
    assert sorted(map(tuple, listed)) == [("raw", 2, "q", "x", "no decimal(38,10)"), ("raw", 2, "t", "never", "no timestamp")]
    spark.createDataFrame([(1, "5", "2024-01-01")], "bronze_row_id long, q string, t string").write.mode("overwrite").parquet(tables.folder("x", "raw"))
    assert [r.status for r in run_many(plans, tables, reload=True)] == ["succeeded"] and tables.read("rejected", "p").count() == 0


def test_numbers_stay(spark):
    rows = lambda *keys: spark.createDataFrame([(k, 1) for k in keys], "k string, v int")
    first = renumbered(rows("b", None, "d"), None, ["k"], "n")
    assert {r.k: r.n for r in first.collect()} == {None: 1, "b": 2, "d": 3}
    second = renumbered(rows("a", "b", None, "c", "d"), first, ["k"], "n")
    assert {r.k: r.n for r in second.collect()} == {None: 1, "b": 2, "d": 3, "a": 4, "c": 5}
    third = renumbered(rows("c", "e"), second, ["k"], "n")
    assert {r.k: r.n for r in third.collect()} == {"c": 5, "e": 6}
    assert renumbered(rows(), third, ["k"], "n").count() == 0
