"""Exact top-k and the hash-prefix forest against brute force."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from rowtide.llm import forest, topk

SCHEMA = "vec_id long, embedding array<float>, rank string"


def vectors(spark, n=600, dim=8, seed=0):
    rng = np.random.default_rng(seed)
    data = rng.standard_normal((n, dim)).astype(np.float32)
    data[n // 2:n // 2 + 40] = data[3]
    return data.astype(np.float64), spark.createDataFrame([(i, v.tolist(), "x") for i, v in enumerate(data)], SCHEMA)


def answers(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r["query_id"], r["rank"])):
        out.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    return out


@pytest.mark.parametrize("shard_rows", [10_000, 20])
def test_top_k_is_exact(spark, shard_rows):
    data, df = vectors(spark)
    got = answers(topk.exact_top_k(df, F.col("vec_id") % 50 == 0, 5, shard_rows=shard_rows, tile_rows=5))
    whole = np.floor(256 * data).astype(np.int64)
    for q in range(0, len(data), 50):
        scores = whole @ whole[q]
        order = [i for i in np.lexsort((np.arange(len(data)), -scores)) if i != q][:5]
        assert got[q] == [(i, scores[i]) for i in order]


def test_top_k_of_large_integers(spark):
    df = spark.createDataFrame([(0, [1e7, 1.0], ""), (1, [1e7, 2.0], ""), (2, [1e7, 1.0], "")], SCHEMA)
    whole = [[int(256 * 1e7), 256], [int(256 * 1e7), 512], [int(256 * 1e7), 256]]
    got = answers(topk.exact_top_k(df, F.col("vec_id") == 0, 5))
    assert got[0] == [(i, sum(a * b for a, b in zip(whole[0], whole[i]))) for i in (1, 2)]


@pytest.mark.parametrize("search", [
    lambda df: topk.exact_top_k(df, F.col("vec_id") % 2 == 0, 3), lambda df: forest.nearest(df, F.col("vec_id") % 2 == 0, 3),
])
def test_defined_cases(spark, search):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 2.0], ""), (1, [1.0, 2.0], ""), (1, [1.0, 2.0], ""), (None, [1.0, 2.0], ""), (2, None, ""), (4, [], ""),
        (6, [nan, 1.0], ""), (8, [inf, 1.0], ""), (10, [None, 1.0], ""), (12, [1.0, 2.0, 3.0], ""),
    ]
    got = answers(search(spark.createDataFrame(rows, SCHEMA)))
    assert {q: [i for i, _ in a] for q, a in got.items()} == {0: [1]}
    assert search(spark.createDataFrame([], SCHEMA)).count() == 0


def test_zero_vectors_are_not_near(spark):
    rows = [(0, [0.0, 0.0], ""), (1, [0.1, 0.0], ""), (2, [0.2, 0.0], "")]
    got = answers(forest.nearest(spark.createDataFrame(rows, SCHEMA), F.lit(True), 3))
    assert {q: [i for i, _ in a] for q, a in got.items()} == {1: [2], 2: [1]}


def test_forest_finds_nine_of_ten(spark):
    df = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = df.orderBy("vec_id").collect()
    data = np.array([r["embedding"] for r in rows], np.float64)
    got = answers(forest.nearest(df, F.col("vec_id") % 20 == 0, 10, shard_rows=500))
    hits = total = 0
    for q, found in got.items():
        apart = np.sqrt(((data - data[q]) ** 2).sum(axis=1))
        want = [i for i in np.argsort(apart, kind="stable") if i != q][:10]
        hits += len({i for i, _ in found} & set(want))
        total += 10
        assert all(abs(score - apart[i]) < 1e-12 for i, score in found)
        assert found == sorted(found, key=lambda f: (f[1], f[0]))
    assert hits / total >= 0.9


def test_ties_of_equal_vectors_go_to_small_ids(spark):
    rows = [(i, [0.5, 0.5], "") for i in range(300)] + [(i, [float(i), 1.0], "") for i in range(300, 400)]
    got = answers(forest.nearest(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") == 7, 10))
    assert got[7] == [(i, 0.0) for i in range(11) if i != 7]
