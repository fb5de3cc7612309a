"""Tables that several writers add to: commits, filters of hashes, and upserts that rewrite few files."""

from __future__ import annotations

import uuid
from concurrent.futures import ThreadPoolExecutor

import numpy as np
import pytest
from pyspark.sql import functions as F

from lamina.operators.checks import ConstraintError
from lamina.operators.latest import upsert
from lamina.sources import commits, filters
from lamina.sources.database import Database
from lamina.sources.tables import Tables



@pytest.fixture
def tables(spark, tmp_path):
    return Tables(spark, str(tmp_path / "data"))


def content(spark, ids, parts: int = 2):
    return spark.createDataFrame([(f"h{i}" if i is not None else None, n, "x") for n, i in enumerate(ids)], "hash_key string, place long, other string").repartition(parts)


def add(tables, ids) -> int:
    return tables.append_new("raw", "t", content(tables.spark, ids), [F.col("place").asc()], drop=("place",))


def test_only_new_content_is_added_and_numbered(tables):
    assert add(tables, [3, 1, 1, None, 2, None]) == 5
    assert add(tables, [2, 4, 4, None]) == 2
    assert add(tables, [1, 2]) == 0 and add(tables, []) == 0
    got = sorted(tables.read("raw", "t").select("bronze_row_id", "hash_key").collect())
    assert [r.bronze_row_id for r in got] == list(range(1, 8))
    assert [r.hash_key for r in got] == ["h3", "h1", None, "h2", None, "h4", None]


def test_writers_at_once_add_each_content_once(tables):
    with ThreadPoolExecutor(5) as pool:
        added = list(pool.map(lambda n: add(tables, [*range(10), 100 + n]), range(5)))
    rows = tables.read("raw", "t").collect()
    assert sorted(r.hash_key for r in rows) == sorted([f"h{i}" for i in range(10)] + [f"h{100 + n}" for n in range(5)])
    assert sorted(r.bronze_row_id for r in rows) == list(range(1, 16)) and sum(added) == 15
    assert sorted(n for n in tables.commits("raw", "t").names() if n.startswith("_t-")) == []


def test_a_number_is_committed_once(tables):
    log = tables.commits("raw", "t")
    state = log.state()
    assert log.put(state, add=["a"]) and not log.put(state, add=["b"])
    assert log.state().files == ["a"] and log.state().number == 1


def test_whole_states_give_the_same(tables, monkeypatch):
    monkeypatch.setattr(commits, "WHOLE", 3)
    log = tables.commits("raw", "t")
    for n in range(8):
        assert log.put(log.state(), add=[f"f{n}"], remove=[f"f{n - 4}"], facts={"filters": [f"b{n}"]}, batches={"s": n}, top=n)
    state = log.state()
    assert state.files == ["f4", "f5", "f6", "f7"] and state.facts == {"filters": [f"b{n}" for n in range(8)]} and state.batches == {"s": 7} and state.top == 7


def test_an_older_folder_is_gone_on_with(tables):
    content(tables.spark, [1, 2]).withColumn("bronze_row_id", F.col("place") + 7).drop("place").write.parquet(tables.folder("raw", "t"))
    assert add(tables, [2, 3]) == 1
    assert sorted((r.bronze_row_id, r.hash_key) for r in tables.read("raw", "t").collect()) == [(7, "h1"), (8, "h2"), (9, "h3")]


def test_a_batch_is_added_once(tables):
    row = tables.spark.range(1)
    for batch in (("s", 0), ("s", 1), ("s", 1), ("s", 0), ("other", 0), None, None):
        tables.append("raw", "log", row, batch)
    assert tables.read("raw", "log").count() == 5


def test_a_failed_writer_leaves_nothing_to_read(tables):
    add(tables, [1])
    bad = content(tables.spark, [2]).withColumn("other", F.expr("raise_error('lost')"))
    with pytest.raises(Exception, match="lost"):
        tables.append_new("raw", "t", bad, [F.col("place").asc()], drop=("place",))
    with pytest.raises(Exception, match="lost"):
        tables.append("raw", "t", bad)
    assert [r.hash_key for r in tables.read("raw", "t").collect()] == ["h1"]


def test_filters_say_which_files_to_read(tables):
    for n in range(6):
        add(tables, range(100 * n, 100 * n + 100))
    state = tables.commits("raw", "t").state()
    asked = lambda *ids: tables.may_hold("raw", "t", state, content(tables.spark, ids).select("hash_key"))
    assert len(asked(5)) == 1 and len(asked(5, 250, 251)) <= 3 and asked(-1, -2) == []
    held = tables._of_files("raw", "t", asked(5)).filter("hash_key = 'h5'").count()
    assert held == 1
    assert len(asked(*range(600))) == len([f for f in state.files])


def test_filters_never_deny_a_hash(spark, tmp_path, monkeypatch):
    rng = np.random.default_rng(1)
    ids = rng.integers(-(2**62), 2**62, 3000).tolist()
    spark.createDataFrame([(f"h{i}",) for i in ids], "hash_key string").repartition(3).write.parquet(str(tmp_path / "f"))
    rows = spark.read.parquet(str(tmp_path / "f"))
    made = filters.filters_of(rows, "hash_key").collect()
    for r in made:
        bits = np.unpackbits(np.frombuffer(r.bits, np.uint8)).astype(bool)
        name = F.element_at(F.split("_metadata.file_path", "/"), -1)
        own = np.array([x.h for x in rows.filter(name == r.file).select(F.xxhash64("hash_key").alias("h")).collect()])
        assert bits[filters._probes(own, len(bits)).astype(np.int64)].all()
        other = rng.integers(-(2**62), 2**62, 20_000)
        assert bits[filters._probes(other, len(bits)).astype(np.int64)].all(axis=1).mean() < 1e-3


def keyed(spark, rows):
    return spark.createDataFrame(rows, "k string, n int, v int")


def test_upsert_leaves_files_without_its_keys(tables, monkeypatch):
    monkeypatch.setattr("lamina.sources.tables.UPSERT_ROWS", 50)
    spark = tables.spark
    first = [(f"k{i:03d}", i % 3 or None, 0) for i in range(200)]
    assert tables.upsert("raw", "t", keyed(spark, first), ["k", "n"]) == []
    before = tables.commits("raw", "t").state().files
    assert len(before) > 1
    delta = [("k000", None, 1), ("k001", 1, 1), ("k001", 2, 1), ("new", None, 1)]
    touched = tables.upsert("raw", "t", keyed(spark, delta), ["k", "n"])
    after = tables.commits("raw", "t").state().files
    assert len(touched) == 1 and set(before) - set(after) == set(touched)
    want = upsert(keyed(spark, first), keyed(spark, delta), ["k", "n"])
    assert sorted(map(repr, tables.read("raw", "t").collect())) == sorted(map(repr, want.collect()))


def test_upserts_equal_the_whole_form(tables):
    spark, rng, want = tables.spark, np.random.default_rng(3), {}
    for turn in range(6):
        keys = {(f"k{int(i)}", [None, 1, 2][int(i) % 3]) for i in rng.integers(0, 60, 12)}
        delta = [(*k, turn) for k in keys]
        tables.upsert("raw", "t", keyed(spark, delta), ["k", "n"])
        want |= {r[:2]: turn for r in delta}
    assert {(r.k, r.n): r.v for r in tables.read("raw", "t").collect()} == want
    assert tables.read("raw", "t").count() == len(want)
    with pytest.raises(ConstraintError):
        tables.upsert("raw", "t", keyed(spark, [("a", None, 1), ("a", None, 2)]), ["k", "n"])
    assert tables.upsert("raw", "t", keyed(spark, []), ["k", "n"]) == []


def test_inserts_check_what_they_add_only(tables):
    """The errors are those of a check of the whole table."""
    spark, rng, there = tables.spark, np.random.default_rng(4), []
    for turn in range(7):
        delta = [(f"k{int(i)}", [None, 1][int(i) % 2], turn) for i in rng.integers(0, 40, 3 + turn % 3)]
        whole = [r[:2] for r in there + delta]
        if len(set(whole)) == len(whole):
            tables.insert("raw", "t", keyed(spark, delta), ["k", "n"], ["v"])
            there += delta
        else:
            with pytest.raises(ConstraintError):
                tables.insert("raw", "t", keyed(spark, delta), ["k", "n"], ["v"])
        if there:
            assert sorted(map(repr, map(tuple, tables.read("raw", "t").collect()))) == sorted(map(repr, there))
    with pytest.raises(ConstraintError, match="null in v"):
        tables.insert("raw", "t", keyed(spark, [("new", 1, None)]), ["k", "n"], ["v"])


def test_writers_at_once_upsert_all(tables):
    spark = tables.spark
    tables.upsert("raw", "t", keyed(spark, [(f"k{i}", 1, -1) for i in range(40)]), ["k", "n"])
    with ThreadPoolExecutor(4) as pool:
        list(pool.map(lambda n: tables.upsert("raw", "t", keyed(spark, [(f"k{i}", 1, n) for i in range(n, 40, 4)]), ["k", "n"]), range(4)))
    assert {r.k: r.v for r in tables.read("raw", "t").collect()} == {f"k{i}": i % 4 for i in range(40)}


def test_writers_at_once_in_a_database(spark):
    database = Database(spark, f"jdbc:derby:memory:{uuid.uuid4().hex};create=true", {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"})
    put = lambda ids: database.append_new("raw", "t", content(spark, ids, 1), [F.col("place").asc()], drop=("place",))
    assert put([0, 9, 0]) == 2
    with ThreadPoolExecutor(4) as pool:
        added = list(pool.map(lambda n: put([*range(8), 50 + n]), range(4)))
    rows = database.read("raw", "t").collect()
    assert sorted(r.hash_key or "" for r in rows) == sorted(["h9", *[f"h{i}" for i in range(8)], *[f"h{50 + n}" for n in range(4)]])
    assert len({r.bronze_row_id for r in rows}) == 13 and sum(added) == 11  # numbers of rows that came to nothing stay unused
    run = spark.createDataFrame([("s-1",)], "pipeline_run_id string")
    assert [database.append("raw", "log", run, ("s", 1)) for _ in range(2)] == [1, 0]
