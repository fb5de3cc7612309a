"""The database source and sink on an embedded database."""

from __future__ import annotations

import json
import uuid

import pytest

from lamina.plans.registry import RAW, STAGING, default_registry
from lamina.plans.runner import run_many
from lamina.sources.database import Database, Layers, jdbc_url, url_from_environment
from lamina.sources.ingest import Settings, ingest, sink_for
from lamina.sources.tables import Tables


@pytest.fixture
def database(spark):
    return Database(spark, f"jdbc:derby:memory:{uuid.uuid4().hex};create=true", {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}, batch_size=2)


def test_addresses(monkeypatch):
    assert jdbc_url("postgres://a:b%40c@host:5433/db?sslmode=require\n") == ("jdbc:postgresql://host:5433/db?sslmode=require", {"user": "a", "password": "b@c"})
    assert jdbc_url("jdbc:derby:memory:x") == ("jdbc:derby:memory:x", {})
    for name in ("DATABASE_URL", "PGUSER", "PGPASSWORD", "PGPORT", "PGDATABASE"):
        monkeypatch.delenv(name, raising=False)
    monkeypatch.setenv("PGHOST", "db1")
    assert jdbc_url(url_from_environment()) == ("jdbc:postgresql://db1:5432/pipeline", {"user": "postgres", "password": "postgres"})
    monkeypatch.setenv("DATABASE_URL", " postgresql://u@h/d ")
    assert jdbc_url(url_from_environment()) == ("jdbc:postgresql://h/d", {"user": "u"})


def test_rows_of_known_hash_are_ignored(spark, database):
    rows = lambda *ids: spark.createDataFrame([(i, f"h{i}", "t") for i in ids], "bronze_row_id long, hash_key string, `index` string").repartition(3)
    assert not database.exists("raw", "t") and database.list("raw") == []
    assert database.append("raw", "t", rows(1, 2, 3, 4, 5)) == 5
    assert database.append("raw", "t", rows(4, 5, 6)) == 1
    assert database.list("raw") == ["t"]
    got = sorted((r.bronze_row_id, r.hash_key, r["index"]) for r in database.read("raw", "t").collect())
    assert got == [(i, f"h{i}", "t") for i in range(1, 7)]
    database.rows_per_task = 2
    read = database.read("raw", "t")
    assert read.rdd.getNumPartitions() == 3 and read.count() == 6


def test_a_failed_write_leaves_nothing(spark, database):
    good = spark.createDataFrame([(1, "h1")], "bronze_row_id long, hash_key string")
    database.append("raw", "t", good)
    bad = spark.range(100).selectExpr("id AS bronze_row_id", "CASE WHEN id = 99 THEN raise_error('lost') ELSE concat('x', id) END AS hash_key").repartition(4)
    with pytest.raises(Exception, match="lost"):
        database.append("raw", "t", bad)
    assert database.list("raw") == ["t"] and database.read("raw", "t").count() == 1


def test_ingestion_and_layers(spark, database, tmp_path):
    record = {"FirmId": "F", "TspDuns": "61", "AmendRptgDesc": None, "locations": [], "rates": []}
    payload = {"feedType": "gTRAN_FIRM", "contracts": [record | {"Id": "7"}, record | {"Id": "8"}]}
    file = tmp_path / "a.json"
    file.write_text(json.dumps(payload))
    settings = Settings(sink="postgres", source_system="S")
    tables = Layers(Tables(spark, str(tmp_path / "layers")), {RAW: database})
    assert sink_for("postgres", tables) is tables and sink_for("jdbc", database) is database
    first, again = (ingest(spark, str(file), tables, settings) for _ in range(2))
    assert (first.rows_written, again.rows_written) == (2, 0)
    raw = database.read(RAW, "gtran_firm")
    assert sorted(r.bronze_row_id for r in raw.collect()) == [1, 2] and database.read(RAW, "ingestion_log").count() == 2
    done = run_many(default_registry(), tables, ["silver_firm_core_dedup"])
    assert [(r.status, r.rows) for r in done] == [("succeeded", 2)], done
    assert tables.read(STAGING, "firm_core_dedup").count() == 2 and tables.list(STAGING) == ["firm_core_dedup"]
