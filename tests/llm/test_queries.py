"""Registered queries of the subpackage: against their SQL, or for their columns, on the smallest data set."""

from __future__ import annotations

import collections
import os

import duckdb
import pytest

from rowtide.llm.queries import ORACLE_SQL, QUERIES

SF_DIR = "/root/testdata/sf0.001"

COLUMNS = {
    "op1_toxicity": {"doc_id", "held_out", "score", "predicted"},
    "op2_packing": {"doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"},
    "op4_nearest": {"query_id", "rank", "vec_id", "score"},
    "op5_language": {"doc_id", "held_out", "lang_pred", "score"},
    "op7_repeats": {"doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"},
    "op8_licenses": {"doc_id", "paragraph", "family", "probability", "similarity", "confirmed"},
}


def test_every_query_is_checked():
    assert set(QUERIES) == set(COLUMNS) | set(ORACLE_SQL)


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_sql(spark, name):
    oracle = duckdb.connect()
    for table in os.listdir(SF_DIR):
        oracle.execute(f"CREATE VIEW {table.removesuffix('.parquet')} AS SELECT * FROM '{SF_DIR}/{table}'")
    df = QUERIES[name](spark, SF_DIR)
    columns = sorted(df.columns)
    expected = oracle.execute(ORACLE_SQL[name])
    names = [d[0] for d in expected.description]
    assert sorted(names) == columns
    places = [names.index(c) for c in columns]
    want = collections.Counter(tuple(row[p] for p in places) for row in expected.fetchall())
    assert collections.Counter(tuple(r) for r in df.select(*columns).collect()) == want


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_query_has_its_columns(spark, name):
    df = QUERIES[name](spark, SF_DIR)
    assert COLUMNS[name] <= set(df.columns)
    assert df.count() > 0
