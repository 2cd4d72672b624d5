from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from rowtide.operators import identity
from rowtide.operators.duplicates import duplicate_keys, keep_last, keep_single
from rowtide.operators.identity import next_value, with_ordinal
from rowtide.sources.tables import sorted_by_keys


@pytest.mark.parametrize("most", [0, 1000])
def test_ordinals_are_dense_and_follow_the_order(spark, monkeypatch, most):
    monkeypatch.setattr(identity, "COUNTED_ON_THE_WAY", most)
    values = list(range(500))
    random.Random(1).shuffle(values)
    source = spark.createDataFrame([(v,) for v in values], "v int").repartition(7)
    numbered = with_ordinal(source, "v", "n")
    assert sorted(map(tuple, numbered.collect())) == [(v, v) for v in range(500)]


def test_one_value_may_fill_most_rows(spark):
    source = spark.createDataFrame([(5, "copy")] * 300 + [(v, "x") for v in range(10)], "v int, w string").repartition(6)
    numbered = with_ordinal(source, "v", "n")
    rows = sorted(numbered.collect(), key=lambda r: r.n)
    assert [r.n for r in rows] == list(range(310))
    assert [r.v for r in rows] == sorted(r.v for r in rows)
    assert numbered.where("v = 5").select(F.spark_partition_id().alias("p")).distinct().count() > 1


def test_rows_can_be_numbered_as_they_are_read(spark):
    source = spark.range(0, 100, 1, 4).toDF("v")
    assert [tuple(r) for r in with_ordinal(source, name="n").orderBy("n").collect()] == [(v, v) for v in range(100)]


def test_ordinals_do_not_change_between_reads(spark):
    source = spark.range(200).select(F.rand().alias("v"))
    numbered = with_ordinal(source, "v", "n")
    assert sorted(map(tuple, numbered.collect())) == sorted(map(tuple, numbered.collect()))


def test_an_empty_source_has_no_numbers(spark):
    assert with_ordinal(spark.range(0).toDF("v"), "v", "n").collect() == []
    assert with_ordinal(spark.createDataFrame([], "v int"), "v", "n").collect() == []


def test_next_value_of_an_empty_table(spark):
    empty = spark.createDataFrame([], "id int")
    assert spark.range(1).select(next_value(empty, "id").alias("n")).first().n == 1


def test_keep_last_against_brute_force(spark):
    dice = random.Random(2)
    rows = [("hot" if n % 3 == 0 else f"k{dice.randrange(9)}", dice.randrange(50), n) for n in range(400)]
    df = spark.createDataFrame(rows, "k string, seq int, v int").repartition(5)
    best = {}
    for k, seq, v in rows:
        best[k] = max(best.get(k, (-1, -1)), (seq, v))
    assert {r.k: (r.seq, r.v) for r in keep_last(df, ["k"], "seq").collect()} == best


def test_hot_key_is_reduced_before_the_shuffle(spark):
    df = spark.range(10).selectExpr("id % 2 AS k", "id AS seq")
    plan = keep_last(df, ["k"], "seq", sequence_is_distinct=True)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_keep_single_passes_unique_keys_and_stops_on_others(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    assert sorted(map(tuple, keep_single(df, ["k"]).collect())) == [(1, "a"), (2, "b")]
    with pytest.raises(Exception, match="duplicate match key"):
        keep_single(df.unionByName(df.limit(1)), ["k"]).collect()


def test_duplicate_keys_are_counted(spark):
    df = spark.createDataFrame([(1, 1), (1, 1), (1, 2), (2, 1)], "a int, b int")
    assert duplicate_keys(df, ["a", "b"]).collect() == [(1, 1, 2)]


def test_sorted_layout_splits_a_hot_key_and_keeps_ranges(spark):
    rows = [(7, "copy")] * 600 + [(v, "x") for v in range(20)]
    df = spark.createDataFrame(rows, "k int, v string").repartition(8)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        laid = sorted_by_keys(df, ["k"]).withColumn("p", F.spark_partition_id()).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert sorted((r.k, r.v) for r in laid) == sorted(rows)
    assert len({r.p for r in laid if r.k == 7}) > 1
    spans = {}
    for r in laid:
        low, high = spans.get(r.p, (r.k, r.k))
        spans[r.p] = (min(low, r.k), max(high, r.k))
    ordered = [spans[p] for p in sorted(spans)]
    assert all(a[1] <= b[0] for a, b in zip(ordered, ordered[1:]))
