"""Every registered query against its SQL on the smallest data set."""

from __future__ import annotations

import collections
import os

import duckdb
import pytest

import __spark_entry__ as entry_points
from catalog.changes import QUERIES
from catalog.oracle import ORACLE_SQL

SF_DIR = "/root/testdata/sf0.001"
TABLES = sorted(name.removesuffix(".parquet") for name in os.listdir(SF_DIR) if name.endswith(".parquet"))


@pytest.fixture(scope="module")
def oracle():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return connection


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE_SQL)
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, oracle, name):
    df = QUERIES[name](spark, SF_DIR)
    columns = sorted(df.columns)
    expected = oracle.execute(ORACLE_SQL[name])
    names = [d[0] for d in expected.description]
    assert sorted(names) == columns
    places = [names.index(c) for c in columns]
    want = collections.Counter(tuple(row[p] for p in places) for row in expected.fetchall())
    assert collections.Counter(tuple(r) for r in df.select(*columns).collect()) == want


def test_flagship_query(spark):
    df = entry_points.entry(spark)
    assert df.columns == ["o_orderkey", "action"]
    assert df.count() > 0
