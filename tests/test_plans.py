"""What the plans look like: pruned scans, pushed filters, no cross joins, the target kept in place."""

from __future__ import annotations

import pytest

from catalog import fixtures as fx
from catalog.changes import QUERIES
from rowtide import insert, merge
from rowtide.plans import joins

SF_DIR = "/root/testdata/sf0.001"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - {"stream_merge"}))
def test_no_cross_joins_and_no_python_in_the_plan(spark, name):
    plan = plan_of(QUERIES[name](spark, SF_DIR))
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "MapInPandas", "BatchEvalPython"):
        assert operator not in plan


def test_filters_and_columns_reach_the_scan(spark):
    plan = plan_of(merge(fx.on_file(spark, SF_DIR), fx.feed(spark, SF_DIR), fx.ORDERS).sequence("seq", True)
                   .check_token(False).plan().counts)
    scans = [line for line in plan.splitlines() if "FileScan" in line]
    assert scans and all("PushedFilters: [IsNotNull(o_orderdate)" in line for line in scans)
    assert all("o_totalprice" not in line and "o_orderpriority" not in line for line in scans)


def test_a_large_target_is_not_shuffled_for_a_small_source(spark, monkeypatch):
    monkeypatch.setattr(joins, "LARGE", 0)
    operation = merge(fx.on_file(spark, SF_DIR), fx.feed(spark, SF_DIR), fx.ORDERS).sequence("seq", True)
    plan = plan_of(operation.check_token(False).plan().rows)
    assert "LeftOuter, BuildRight" in plan and "FullOuter" not in plan


def test_two_shuffled_sides_meet_in_one_join(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        operation = merge(fx.on_file(spark, SF_DIR), fx.feed(spark, SF_DIR), fx.ORDERS).sequence("seq", True)
        plan = plan_of(operation.check_token(False).plan().snapshot)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    # One shuffle per side: dropping duplicates leaves the source where the join wants it.
    assert plan.count("Exchange hashpartitioning") == 2
    assert "FullOuter" in plan and "Broadcast" not in plan


def test_a_bucketed_table_is_joined_where_it_lies(spark):
    for name in ("bucketed_one", "bucketed_two"):
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        first = insert(fx.on_file(spark, SF_DIR), fx.first_time(spark, SF_DIR), fx.ORDERS).if_missing()
        assert first.save_table("bucketed_one", buckets=4).inserted > 0
        second = merge(spark.table("bucketed_one"), fx.feed(spark, SF_DIR), fx.ORDERS).sequence("seq", True)
        plan = plan_of(second.check_token(False).plan().snapshot)
        # The source's shuffle is the only one.
        assert plan.count("Exchange hashpartitioning") == 1 and "FullOuter" in plan
        assert second.save_table("bucketed_two", buckets=4).updated > 0
        assert spark.table("bucketed_two").count() == fx.table(spark, SF_DIR, "orders").count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_a_chain_on_one_key_keeps_its_partitioning(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(QUERIES["op_chain"](spark, SF_DIR))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    # The table once, and the source of the update and of the delete.
    assert plan.count("Exchange hashpartitioning") <= 4
