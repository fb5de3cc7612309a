"""Tables that only serve others of a run go once those are built; and tables are compressed for texts."""

from __future__ import annotations

import pytest

from lamina.plans.registry import Plan, Registry
from lamina.plans.runner import run_many
from lamina.sources.tables import Tables


@pytest.fixture
def tables(spark, tmp_path):
    return Tables(spark, str(tmp_path / "data"))


def registry(spark, broken: str = "") -> Registry:
    """b and c read a, d reads b and c, e reads nothing and nothing reads it."""
    out, reads = Registry(), {"a": (), "b": ("a",), "c": ("a",), "d": ("b", "c"), "e": ()}

    def build(name):
        def f(there):
            if name == broken:
                raise ValueError("broken")
            rows = spark.range(3)
            for x in reads[name]:
                rows = rows.join(there[x].select("id"), "id")
            return rows

        return f

    for name in reads:
        out.register(Plan(name, "x", name, "firm", "g", tuple(("x", s) for s in reads[name]), build(name), key=("id",)))
    return out


def test_tables_that_only_serve_others_go(spark, tables):
    assert [(r.status, r.rows) for r in run_many(registry(spark), tables, kept=["d"])] == [("succeeded", 3)] * 5
    assert tables.list("x") == ["d", "e"] and tables.read("x", "d").count() == 3


def test_what_a_failed_table_reads_stays(spark, tables):
    done = run_many(registry(spark, "c"), tables, kept=["d"])
    assert {r.name: r.status for r in done} == {"a": "succeeded", "b": "succeeded", "c": "failed", "d": "skipped", "e": "succeeded"}
    assert tables.list("x") == ["a", "b", "e"]
    assert [r.status for r in run_many(registry(spark), tables, ["c", "d"], kept=["d"])] == ["succeeded"] * 2


def test_all_stay_unless_asked(spark, tables):
    run_many(registry(spark), tables)
    assert tables.list("x") == ["a", "b", "c", "d", "e"]


def test_files_are_compressed_for_texts(spark, tables, tmp_path):
    tables.replace("x", "t", spark.range(5))
    tables.append("x", "u", spark.range(5))
    assert len(list(tmp_path.rglob("part-*.zstd.parquet"))) == len(list(tmp_path.rglob("part-*.parquet"))) > 1
