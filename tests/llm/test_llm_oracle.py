"""Queries of the training-data operators that SQL can express give what DuckDB gives."""

from __future__ import annotations

import os

import duckdb
import pytest

from lamina.llm.queries import oracle_sql, queries

SF = "/root/testdata/sf0.01"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    for file in os.listdir(SF):
        con.sql(f"CREATE VIEW {file.split('.')[0]} AS SELECT * FROM '{SF}/{file}'")
    made = con.execute(oracle_sql()[name])
    columns = [d[0] for d in made.description]
    df = queries()[name](spark, SF)
    assert sorted(df.columns) == sorted(columns)
    assert sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr) == sorted(made.fetchall(), key=repr)


def test_every_query_has_its_number():
    assert [name.split("_")[0] for name in queries()] == [f"op{n}" for n in range(1, len(queries()) + 1)]
