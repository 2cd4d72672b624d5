"""What is written once, checked afterwards, and only then seen."""

from __future__ import annotations

import json
import os
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from rowtide import (
    ConcurrencyMismatch, ConfigurationError, ConstraintError, Counts, DuplicateKeysError, ExecutionError, NotMatched, TableSpec,
    delete, insert, merge, update,
)
from rowtide.errors import CONSTRAINT_MARK, translated
from rowtide.operators import classify, constraints
from rowtide.operators.chain import Chain
from rowtide.operators.constraints import unique_violations
from rowtide.operators.identity import with_ordinal
from rowtide.operators.outcome import stored_counts
from rowtide.plans import joins
from rowtide.sources.tables import Layout
from tests.conftest import BOOKS, by_isbn

SPEC = TableSpec("t", keys=("k",))
UNIQUE = TableSpec("t", keys=("k",), unique=(("v",),))


@pytest.fixture
def counted(spark):
    """A table of 100 rows, and how often its rows were read so far."""
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    table = spark.createDataFrame([(n, f"v{n}") for n in range(100)], "k long, v string")
    return table.mapInArrow(count, table.schema), lambda: seen.value / 100


def feed(spark, *rows):
    return spark.createDataFrame([(*row, n) for n, row in enumerate(rows)], "k long, v string, n long")


READS = {
    "merge": (1, lambda t, s: merge(t, s, UNIQUE).sequence("n").strategy("full").fail_on_mismatch()),
    "split": (2, lambda t, s: merge(t, s, UNIQUE).sequence("n").strategy("split").fail_on_mismatch()),
    "mirror": (1, lambda t, s: merge(t, s, SPEC).sequence("n").strategy("full").delete_unmatched().fail_on_mismatch()),
    "update": (1, lambda t, s: update(t, s.where("k < 50"), UNIQUE).require_all_matched(count_source_rows=True).fail_on_mismatch()),
    "delete": (1, lambda t, s: delete(t, s.where("k < 50"), SPEC).fail_on_mismatch()),
    "missing": (2, lambda t, s: insert(t, s, UNIQUE).if_missing("k")),
    "insert": (1, lambda t, s: insert(t, s.where("k > 50"), UNIQUE)),
}


@pytest.mark.parametrize("name", sorted(READS))
def test_a_write_reads_the_table_no_more_often_than_its_joins(spark, counted, name, tmp_path):
    table, reads = counted
    times, build = READS[name]
    source = feed(spark, (3, "new"), (4, "newer"), (500, "added"))
    build(table, source).save(str(tmp_path / "next"))
    assert reads() == times
    assert os.listdir(tmp_path) == ["next"]


@pytest.mark.parametrize("build, error", [
    (lambda t, s: update(t, s, SPEC).fail_on_mismatch(), ConcurrencyMismatch),
    (lambda t, s: update(t, s, SPEC).require_all_matched(), NotMatched),
    (lambda t, s: update(t, s, SPEC).require_all_matched(count_source_rows=True), NotMatched),
    (lambda t, s: merge(t, s.withColumn("v", F.lit("v7")), UNIQUE).sequence("n"), ConstraintError),
    (lambda t, s: insert(t, s, UNIQUE), ConstraintError),
    (lambda t, s: update(t, s.union(s), SPEC), DuplicateKeysError),
])
def test_nothing_is_seen_of_a_failed_write(spark, counted, build, error, tmp_path):
    operation = build(counted[0], feed(spark, (3, "new"), (500, "added")))
    with pytest.raises(error):
        operation.save(str(tmp_path / "next"))
    assert os.listdir(tmp_path) == []
    with pytest.raises(error):
        operation.save_table("never_seen", buckets=4) if operation.kind != "insert" else operation.save(str(tmp_path / "x"))
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("never_seen")]


def test_counters_stay_with_the_snapshot(spark, counted, tmp_path):
    path = str(tmp_path / "next")
    counts = merge(counted[0], feed(spark, (3, "new"), (500, "added")), SPEC).sequence("n").delete_unmatched().ordered().save(path)
    assert counts == Counts(1, 1, 99, 101) == stored_counts(spark, path)
    assert spark.read.parquet(path).count() == 2
    with pytest.raises(ExecutionError, match="exists already"):
        merge(counted[0], feed(spark, (3, "x")), SPEC).sequence("n").save(path)


def test_a_mark_in_a_plan_is_not_a_broken_rule(spark):
    with pytest.raises(Exception) as caught:
        spark.range(1).select(F.concat(F.lit(f"{CONSTRAINT_MARK} ordinal"), F.col("no_such_column")))
    assert type(translated(caught.value)) is ExecutionError
    with pytest.raises(Exception) as caught:
        spark.range(1).select(F.raise_error(F.lit(f"{CONSTRAINT_MARK} a rule"))).collect()
    assert str(translated(caught.value)) == f"{CONSTRAINT_MARK} a rule"


def test_keys_are_required_however_the_spec_was_made(spark, counted, tmp_path):
    with pytest.raises(ConstraintError, match="k"):
        insert(counted[0], feed(spark, (None, "x")), SPEC).save(str(tmp_path / "next"))
    assert constraints.constraint_rejects(feed(spark, (None, "x"), (1, "y")), SPEC).count() == 1


def test_ids_are_not_made_from_repeated_ordinals(books, sent, tmp_path):
    source = sent(("A", "a", 1), ("B", "b", 2)).withColumn("n", F.lit(5))
    with pytest.raises(DuplicateKeysError):
        insert(books(), source, BOOKS).ordinal("n").save(str(tmp_path / "next"))


# ---------------------------------------------------------------- progress


def slow(df):
    """``df`` in tasks that take some time each."""
    def wait(batches):
        import time

        time.sleep(0.4)
        yield from batches

    return df.repartition(12).mapInArrow(wait, df.schema)


def written_by(name, spark, tmp_path, tell):
    source = slow(spark.range(5000).selectExpr("id AS k", "cast(id AS string) AS v", "id AS n"))
    empty = spark.createDataFrame([], "k long, v string")
    operation = insert(empty, source, SPEC).progress(tell)
    if name == "save":
        operation.save(str(tmp_path / "a"))
    elif name == "append_to":
        empty.write.parquet(str(tmp_path / "a"))
        operation.append_to(str(tmp_path / "a"))
    elif name == "append":
        spark.sql("DROP TABLE IF EXISTS told")
        spark.sql("CREATE TABLE told (k BIGINT, v STRING) USING parquet")
        insert(None, source, replace(SPEC, name="told")).progress(tell).append()
    elif name == "save_table":
        spark.sql("DROP TABLE IF EXISTS told_buckets")
        update(spark.range(5000).selectExpr("id AS k", "'' AS v"), source, SPEC).progress(tell).save_table("told_buckets", 8)
    elif name == "chain":
        Chain(empty).then(insert(None, source, SPEC)).save(str(tmp_path / "a"), progress=tell)
    else:
        from rowtide.sources.partitions import PartitionedTable

        table = PartitionedTable(str(tmp_path / "t"), empty.withColumn("p", F.lit(1)).schema, ("p",))
        table.apply(insert(None, source.withColumn("p", F.lit(1)), SPEC), str(tmp_path / "s"), progress=tell)


@pytest.mark.parametrize("name", ["save", "append_to", "append", "save_table", "chain", "apply"])
def test_every_writer_tells_the_running_row_count(spark, tmp_path, name):
    told = []
    written_by(name, spark, tmp_path, told.append)
    assert told and told == sorted(told) and told[-1] == 5000
    if name == "save":
        assert len(told) > 1  # tasks end one after another


# ---------------------------------------------------------------- numbering, unique values, hot keys


def test_numbers_leave_the_size_known(spark):
    source = spark.range(1000).selectExpr("id AS k", "'x' AS v")
    numbered = with_ordinal(source, "k")
    assert joins.estimated_bytes(numbered) < 100 * joins.estimated_bytes(source)
    plan = numbered._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan


def test_an_unsequenced_feed_does_not_move_a_large_table(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(joins, "LARGE", 0)
    spark.range(20_000).selectExpr("id AS k", "cast(id AS string) AS v").write.parquet(str(tmp_path / "t"))
    feed(spark, (3, "new"), (30_000, "added")).drop("n").write.parquet(str(tmp_path / "s"))
    table, source = spark.read.parquet(str(tmp_path / "t")), spark.read.parquet(str(tmp_path / "s"))
    merged = merge(table, source, SPEC).plan()
    plan = merged.rows._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "FullOuter" not in plan
    lines = [line for line in plan.splitlines() if "FileScan" in line or "Exchange hashpartitioning" in line]
    whole = next(n for n, line in enumerate(lines) if "FileScan" in line and "v#" in line)
    assert not any("Exchange hashpartitioning" in line for line in lines[:whole])
    assert merged.check() == Counts(1, 1, 0, 2)


@pytest.mark.parametrize("most", [4_000_000, 5])
def test_touched_values_are_found_behind_a_filter(spark, monkeypatch, most, tmp_path):
    monkeypatch.setattr(constraints, "MOST_FILTERED", most)
    monkeypatch.setattr(constraints, "fits_broadcast", lambda df: False)
    rows = [(n % 50 if n % 3 else None, f"v{n % 7}") for n in range(300)]
    snapshot = spark.createDataFrame(rows, "a int, b string")
    touched = spark.createDataFrame([(1, "v1"), (None, "v3"), (999, "x"), (2, "v2")], "a int, b string")
    found = unique_violations(snapshot, touched, ["a", "b"])
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert ("__bits" in plan) == (most > 5 or most >= 4)
    want = {key: sum(r == key for r in rows) for key in [(1, "v1"), (None, "v3"), (2, "v2")]}
    assert {(r["a"], r["b"]): r["copies"] for r in found.collect()} == {k: n for k, n in want.items() if n > 1}


def test_too_many_touched_values_for_a_filter(spark, monkeypatch):
    monkeypatch.setattr(constraints, "MOST_FILTERED", 1)
    monkeypatch.setattr(constraints, "fits_broadcast", lambda df: False)
    snapshot = spark.createDataFrame([(1,), (1,), (2,), (2,), (3,)], "a int")
    found = unique_violations(snapshot, snapshot.where("a > 1"), ["a"])
    assert "__bits" not in found._jdf.queryExecution().executedPlan().toString()
    assert [tuple(r) for r in found.collect()] == [(2, 2)]


def test_hot_keys_are_looked_for_once_and_only_when_needed(spark, monkeypatch):
    searches = []
    find = joins.hot_keys
    monkeypatch.setattr(classify, "hot_keys", lambda *a: searches.append(a) or find(*a))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        table = spark.range(1000).selectExpr("id % 10 AS k", "id AS v")
        result = delete(table, spark.range(5).selectExpr("id AS k"), TableSpec("t")).match_on("k").plan()
        assert searches == []
        assert result.snapshot.count() == result.removed_rows.count() == 500
        assert result.counts.first().deleted == 500
        assert len(searches) == 1
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_a_frozen_insert_computes_its_rows_once(spark, counted):
    result = insert(counted[0], feed(spark, (500, "added")).withColumn("v", F.uuid()), SPEC).if_missing().plan().freeze()
    assert result.new_rows.collect() == result.new_rows.collect()
    assert result.snapshot.where("k = 500").first().v == result.new_rows.first().v


# ---------------------------------------------------------------- chains


def chained(table, spark):
    """Deletes, re-inserts, mirrors and a token that went stale on the way."""
    return [
        delete(None, spark.createDataFrame([(n,) for n in range(0, 100, 3)], "k long"), SPEC),
        merge(None, feed(spark, *((n, f"again {n}") for n in range(0, 200, 6))), SPEC).sequence("n"),
        insert(None, feed(spark, *((n, f"missing {n}") for n in range(0, 30))), SPEC).if_missing(),
        update(None, feed(spark, *((n, f"changed {n}") for n in range(0, 300, 4))), SPEC),
        merge(None, feed(spark, *((n, f"kept {n}") for n in range(0, 60))), SPEC).sequence("n").delete_unmatched(),
        delete(None, spark.createDataFrame([(n,) for n in range(0, 1000, 5)], "k long"), SPEC),
    ]


@pytest.mark.parametrize("strategy", ["full", "split"])
def test_a_chain_equals_its_steps(spark, strategy, tmp_path):
    table = spark.createDataFrame([(n, f"v{n}") for n in range(100)], "k long, v string")
    steps = [s.strategy(strategy) if s.kind == "merge" else s for s in chained(table, spark)]
    chain, state, want = Chain(table), table, []
    for n, step in enumerate(steps):
        chain.then(step)
        path = str(tmp_path / f"step{n}")
        want.append(step.on(state).save(path))
        state = spark.read.parquet(path)
    assert chain.check() == want
    assert chain.save(str(tmp_path / "whole"), Layout(sort_by=("k",))) == want
    assert sorted(spark.read.parquet(str(tmp_path / "whole")).collect()) == sorted(state.collect())
    assert sorted(chain.snapshot.collect()) == sorted(state.collect())
    with open(tmp_path / "whole" / "_counts.json") as file:
        assert json.load(file)["total_affected"] == sum(w.total_affected for w in want)


def test_a_chain_reads_its_table_once(spark, counted, tmp_path):
    table, reads = counted
    chain = Chain(table)
    for step in chained(table, spark):
        if step.kind != "insert":
            chain.then(step.strategy("full") if step.kind == "merge" else step)
    chain.save(str(tmp_path / "next"))
    assert reads() == 1


def test_ids_in_a_chain_follow_the_rows_that_are_left(books, sent, spark, tmp_path):
    chain = Chain(books("M", 5))
    chain.then(delete(None, sent(("M0005", "", 1)), BOOKS).match_on("isbn"))
    chain.then(insert(None, sent(("N", "new", 1)), BOOKS).ordinal("n"))
    assert chain.save(str(tmp_path / "next")) == [Counts(0, 0, 1, 1), Counts(1, 0, 0, 1)]
    assert by_isbn(spark.read.parquet(str(tmp_path / "next")), "id")["N"] == 5


def test_a_step_that_breaks_a_unique_key_undoes_the_chain(books, sent, tmp_path):
    chain = Chain(books("M", 2))
    chain.then(insert(None, sent(("M0001", "twice", 1)), BOOKS).ordinal("n"))
    chain.then(delete(None, sent(("M0001", "", 1)), BOOKS).match_on("isbn"))
    with pytest.raises(ConstraintError, match="M0001"):
        chain.save(str(tmp_path / "next"))
    assert os.listdir(tmp_path) == []


def test_an_empty_chain_writes_its_table(spark, tmp_path):
    chain = Chain(spark.range(3).toDF("k"))
    assert chain.check() == [] == chain.save(str(tmp_path / "next"))
    assert spark.read.parquet(str(tmp_path / "next")).count() == 3


def test_options_that_would_be_ignored_are_refused(spark, counted):
    operation = update(counted[0], feed(spark, (3, "x")), SPEC)
    with pytest.raises(ConfigurationError, match="ordered"):
        operation.ordered("v").save_table("never_seen", buckets=4)
    with pytest.raises(ConfigurationError, match="batch_size"):
        insert(counted[0], feed(spark, (3, "x")), SPEC).batch_size(10).append()
