"""The fold of postings that come in batches of any order is the fold of all."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from lamina.operators.amendments import NullRule, fold
from lamina.plans.incremental import AmendmentFold
from lamina.sources.tables import Tables

WORDS = ["All Data", "changes only", "New", None, " ", "odd"]


def postings(spark, seed: int, n: int = 160):
    rng = random.Random(seed)
    keys = [("a", 1), ("a", None), (None, None), ("b", 1), ("c", 2), ("d", 3)]
    rows = []
    for i in range(n):
        when = rng.choice([None, *range(12)])
        rows.append((i, *rng.choice(keys), rng.choice(WORDS if rng.random() < 0.7 else [None, "changes only"]), when, rng.choice([None, "x", ""]), rng.choice([None, i])))
    return spark.createDataFrame(rows, "n long, k string, m int, what string, day int, p string, q long").withColumn("ts", F.timestamp_seconds(F.col("day") * 86400))


@pytest.mark.parametrize(("rule", "orphans"), [(NullRule(), True), (NullRule(group=3, running=2), False), (NullRule(group=0, running=0), True)])
def test_batches_equal_the_whole_fold(spark, tmp_path, rule, orphans):
    rows = postings(spark, 7 + 3 * orphans)
    whole = fold(rows, ["k", "m"], ["p", "q"], "what", F.col("ts"), [F.col("n")], rule, orphans)
    kept = AmendmentFold(Tables(spark, str(tmp_path / "t")), "silver", "core", ["k", "m"], ["p", "q"], "what", F.col("ts"), [F.col("n")], rule, orphans)
    for turn, part in enumerate((2, 0, 1)):  # late postings come after newer ones
        kept.add(rows.filter(F.col("n") % 3 == part), ("s", turn))
        if turn == 1:
            kept.add(rows.filter(F.col("n") % 3 == part), ("s", turn))  # run again
    want = sorted(map(repr, whole.select("k", "m", "p", "q", "amend_kind", "amend_postings_applied", "amend_baseline_ts").collect()))
    assert sorted(map(repr, kept.current().collect())) == want


def test_a_batch_leaves_files_without_its_keys(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("lamina.sources.tables.UPSERT_ROWS", 20)
    tables = Tables(spark, str(tmp_path / "t"))
    kept = AmendmentFold(tables, "silver", "core", ["k"], ["p"], "what", F.col("ts"), [F.col("n")], NullRule())
    some = lambda low, high: spark.range(low, high).select(F.col("id").alias("n"), F.format_string("k%03d", "id").alias("k"), F.lit("New").alias("what"), F.timestamp_seconds("id").alias("ts"), F.lit("x").alias("p"))
    kept.add(some(0, 200))
    before = set(tables.commits("silver", "core_state").state().files)
    kept.add(some(5, 7))
    after = set(tables.commits("silver", "core_state").state().files)
    assert len(before) > 5 and len(before - after) == 1 and kept.current().count() == 200
