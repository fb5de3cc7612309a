"""Every query with SQL gives what DuckDB gives on the smallest tables."""

from __future__ import annotations

import datetime
import decimal
import os

import duckdb
import pytest

from lamina import queries as own

SF = os.environ.get("ORACLE_SF", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.fixture(scope="module")
def oracle():
    con = duckdb.connect()
    for name in os.listdir(SF):
        con.sql(f"CREATE VIEW {name.split('.')[0]} AS SELECT * FROM '{SF}/{name}'")
    return con


def plain(x):
    if isinstance(x, bool) or x is None or isinstance(x, (str, datetime.date)):
        return x
    if isinstance(x, (int, float, decimal.Decimal)):
        return round(float(x), 6)
    return str(x)


def rows(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(([plain(r[i]) for i in order] for r in data), key=repr)


@pytest.mark.parametrize("name", sorted(own.oracle_sql()))
def test_query_equals_its_sql(spark, oracle, name):
    df = own.queries()[name](spark, SF)
    got = rows(df.columns, [tuple(r) for r in df.collect()])
    made = oracle.execute(own.oracle_sql()[name])
    assert got == rows([d[0] for d in made.description], made.fetchall())


def test_every_query_has_sql():
    assert set(own.queries()) == set(own.oracle_sql())
