from __future__ import annotations

import os

import pytest
from pyspark.sql import types as T

from rowtide import ConfigurationError, ConstraintError, Counts, DuplicateKeysError, TableSpec, delete, insert, merge, update
from rowtide.sources.buckets import BucketedTable
from rowtide.streaming.upsert import apply_stream

FIELDS = T.StructType([T.StructField("k", T.LongType()), T.StructField("v", T.StringType())])
SPEC = TableSpec("latest", keys=("k",))


@pytest.fixture
def table(spark, tmp_path):
    made = BucketedTable(str(tmp_path / "table"), FIELDS, ("k",), buckets=16)
    made.create(spark.createDataFrame([(n, f"v{n}") for n in range(100)], FIELDS))
    return made


def contents(table, spark):
    return {r.k: r.v for r in table.read(spark).collect()}


def files(table):
    return {
        os.path.join(folder, name)
        for folder, _, names in os.walk(table.path) for name in names if name.endswith(".parquet")
    }


def test_only_touched_buckets_are_rewritten(spark, table, tmp_path):
    before = files(table)
    source = spark.createDataFrame([(3, "new", 1), (500, "added", 2)], "k int, v string, n int")
    counts = table.apply(merge(None, source, SPEC).sequence("n"), str(tmp_path / "s1"))
    assert counts == Counts(1, 1, 0, 2)
    after = contents(table, spark)
    assert after == {**{n: f"v{n}" for n in range(100)}, 3: "new", 500: "added"}
    touched = {name.split("bucket=")[1].split(os.sep)[0] for name in before ^ files(table)}
    assert 1 <= len(touched) <= 2


def test_an_emptied_bucket_disappears(spark, table, tmp_path):
    source = spark.range(100).selectExpr("id AS k")
    assert table.apply(delete(None, source, SPEC), str(tmp_path / "s1")).deleted == 100
    assert contents(table, spark) == {}
    assert table.apply(insert(None, spark.createDataFrame([(1, "x")], FIELDS), SPEC).if_missing(), str(tmp_path / "s2")).inserted == 1
    assert contents(table, spark) == {1: "x"}


def test_a_finished_attempt_is_only_put_in_place_again(spark, table, tmp_path):
    source = spark.createDataFrame([(3, "new")], FIELDS)
    operation = update(None, source, SPEC)
    assert table.apply(operation, str(tmp_path / "s1")).updated == 1
    assert table.apply(operation, str(tmp_path / "s1")) == Counts(0, 1, 0, 1)
    assert contents(table, spark)[3] == "new"


def test_a_failed_attempt_leaves_the_table_alone(spark, table, tmp_path):
    before = files(table)
    twice = spark.createDataFrame([(3, "a"), (3, "b")], FIELDS)
    with pytest.raises(DuplicateKeysError):
        table.apply(update(None, twice, SPEC), str(tmp_path / "s1"))
    assert files(table) == before


def test_mirroring_covers_every_bucket(spark, table, tmp_path):
    source = spark.createDataFrame([(3, "only", 1)], "k long, v string, n int")
    counts = table.apply(merge(None, source, SPEC).sequence("n").delete_unmatched(), str(tmp_path / "s1"))
    assert counts == Counts(0, 1, 99, 100)
    assert contents(table, spark) == {3: "only"}


def test_changes_must_match_on_the_bucket_key(spark, table, tmp_path):
    source = spark.createDataFrame([(3, "x")], FIELDS)
    for operation in (insert(None, source, SPEC), update(None, source, SPEC).match_on("v")):
        with pytest.raises(ConfigurationError):
            table.apply(operation, str(tmp_path / "s1"))


def test_stream_of_changes_in_several_batches(spark, tmp_path):
    table = BucketedTable(str(tmp_path / "table"), FIELDS, ("k",), buckets=4)
    fields = "k long, v string, n long"
    for part, rows in enumerate([[(1, "a", 1), (2, "b", 2), (1, "c", 3)], [(2, "d", 4), (3, "e", 5)]]):
        spark.createDataFrame(rows, fields).coalesce(1).write.mode("append").parquet(str(tmp_path / "in" / str(part)))
    seen = []

    def run():
        stream = spark.readStream.schema(fields).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in" / "*"))
        query = apply_stream(
            stream, table, lambda batch: merge(None, batch, SPEC).sequence("n", distinct_per_key=True),
            checkpoint=str(tmp_path / "progress"), staging=str(tmp_path / "staging"), progress=seen.append,
        )
        query.awaitTermination()

    run()
    assert contents(table, spark) == {1: "c", 2: "d", 3: "e"}
    assert seen == [3, 5]
    spark.createDataFrame([(3, "f", 6)], fields).coalesce(1).write.parquet(str(tmp_path / "in" / "2"))
    run()
    assert contents(table, spark) == {1: "c", 2: "d", 3: "f"}


def test_generated_ids_and_unique_keys_look_beyond_the_touched_buckets(spark, tmp_path):
    fields = T.StructType([
        T.StructField("k", T.LongType()), T.StructField("id", T.LongType()), T.StructField("name", T.StringType()),
    ])
    made = BucketedTable(str(tmp_path / "t"), fields, ("k",), buckets=16)
    made.create(spark.createDataFrame([(n, n, f"n{n}") for n in range(20)], fields))
    spec = TableSpec("t", keys=("k",), identity="id", unique=(("name",),))
    fresh = spark.createDataFrame([(100, "fresh", 0)], "k long, name string, n long")
    made.apply(insert(None, fresh, spec).if_missing().ordinal("n"), str(tmp_path / "s1"))
    assert {r.id for r in made.read(spark).where("k = 100").collect()} == {20}
    for name in ("n3", "n7", "n11"):
        taken = spark.createDataFrame([(200, name, 0)], "k long, name string, n long")
        with pytest.raises(ConstraintError, match=name):
            made.apply(insert(None, taken, spec).if_missing().ordinal("n"), str(tmp_path / f"s-{name}"))
    assert made.read(spark).count() == 21


def test_an_empty_mirror_touches_nothing(spark, table, tmp_path):
    before = files(table)
    nothing = spark.createDataFrame([], "k long, v string, n long")
    assert table.apply(merge(None, nothing, SPEC).sequence("n").delete_unmatched(), str(tmp_path / "s1")) == Counts()
    assert files(table) == before
