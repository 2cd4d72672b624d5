"""Tables in folders and in the catalog, of which a change rewrites what it touches."""

from __future__ import annotations

import os
import uuid

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowtide import ConfigurationError, ConstraintError, Counts, ExecutionError, TableSpec, delete, insert, merge, update
from rowtide.operators.chain import Chain
from rowtide.sources import partitions
from rowtide.sources.buckets import BucketedTable
from rowtide.sources.partitions import PartitionedTable
from rowtide.streaming.upsert import apply_stream

FIELDS = T.StructType([
    T.StructField("k", T.LongType()), T.StructField("v", T.StringType()), T.StructField("day", T.DateType()),
    T.StructField("place", T.StringType()),
])
SPEC = TableSpec("visits", keys=("k",))
PLACES = ("a b", "c/d=%", None, "é")


def rows(spark, *given):
    """Rows (k, v, day of January, place)."""
    made = spark.createDataFrame([(*g, n) for n, g in enumerate(given)], "k long, v string, d int, place string, n long")
    return made.withColumn("day", F.date_add(F.lit("2020-01-01").cast("date"), F.col("d") - 1)).drop("d")


def first_rows():
    return [(n, f"v{n}", 1 + n % 3, PLACES[n % 4]) for n in range(60)]


@pytest.fixture
def table(spark, tmp_path):
    made = PartitionedTable(str(tmp_path / "table"), FIELDS, ("day", "place"))
    made.create(rows(spark, *first_rows()))
    return made


def contents(table, spark):
    return {r.k: (r.v, r.day.day, r.place) for r in table.read(spark).collect()}


def files(table):
    """Path and time of every file."""
    return {
        os.path.join(folder, name): os.stat(os.path.join(folder, name)).st_mtime_ns
        for folder, _, names in os.walk(table.path) for name in names if name.endswith(".parquet")
    }


def folders(found):
    return {os.path.dirname(name) for name in found}


def test_only_touched_partitions_are_rewritten(spark, table, tmp_path):
    before = files(table)
    source = rows(spark, (3, "new", 1, PLACES[3]), (500, "added", 2, "a b"), (501, "added", 9, "new place"))
    counts = table.apply(merge(None, source, SPEC).sequence("n"), str(tmp_path / "s1"))
    assert counts == Counts(2, 1, 0, 3)
    want = {k: (v, d, p) for k, v, d, p in first_rows()}
    assert contents(table, spark) == {**want, 3: ("new", 1, "é"), 500: ("added", 2, "a b"), 501: ("added", 9, "new place")}
    after = files(table)
    kept = {name for name in before if after.get(name) == before[name]}
    # One partition is rewritten; one gains a file, one is new.
    assert len(folders(set(before) - kept)) == 1
    assert len(folders(set(after) - set(before))) == 3


def test_a_key_that_moves_leaves_no_second_row(spark, table, tmp_path):
    source = rows(spark, (3, "moved", 2, "c/d=%"), (7, "moved", 8, None))
    assert table.apply(update(None, source, SPEC), str(tmp_path / "s1")).updated == 2
    want = {k: (v, d, p) for k, v, d, p in first_rows()}
    assert contents(table, spark) == {**want, 3: ("moved", 2, "c/d=%"), 7: ("moved", 8, None)}
    assert table.read(spark).count() == 60


def test_an_emptied_partition_goes(spark, table, tmp_path):
    gone = rows(spark, *(r for r in first_rows() if r[2] == 1 and r[3] is None))
    assert table.apply(delete(None, gone, SPEC), str(tmp_path / "s1")).deleted == gone.count()
    assert table.read(spark).where("day = '2020-01-01' AND place IS NULL").count() == 0
    assert len(folders(files(table))) == 11


def test_inserts_add_files_and_read_keys_only(spark, table, tmp_path):
    before = files(table)
    source = rows(spark, (3, "there", 1, "é"), (900, "new", 1, "é"))
    assert table.apply(insert(None, source, SPEC).if_missing(), str(tmp_path / "s1")) == Counts(1, 0, 0, 1)
    assert before.items() <= files(table).items()
    assert table.apply(insert(None, rows(spark, (901, "new", 1, "é")), SPEC), str(tmp_path / "s2")).inserted == 1
    assert len(contents(table, spark)) == 62
    with pytest.raises(ConstraintError, match="k=3"):
        table.apply(insert(None, rows(spark, (3, "again", 2, "x")), SPEC), str(tmp_path / "s3"))
    assert len(contents(table, spark)) == 62


def test_a_mirror_covers_every_partition(spark, table, tmp_path):
    source = rows(spark, (3, "only", 5, "x"))
    counts = table.apply(merge(None, source, SPEC).sequence("n").delete_unmatched(), str(tmp_path / "s1"))
    assert counts == Counts(0, 1, 59, 60)
    assert contents(table, spark) == {3: ("only", 5, "x")}


@pytest.mark.parametrize("stop_at", [0, 1, 2, 3])
def test_an_interrupted_publication_is_finished_by_the_next_call(spark, table, tmp_path, monkeypatch, stop_at):
    source = rows(spark, (3, "new", 4, "x"), (500, "added", 2, "a b"), (501, "added", 9, "y"))
    operation = merge(None, source, SPEC).sequence("n")
    moves, move = [], partitions.move

    def failing(*arguments):
        if len(moves) == stop_at:
            raise ExecutionError("the driver was lost")
        moves.append(arguments)
        move(*arguments)

    monkeypatch.setattr(partitions, "move", failing)
    with pytest.raises(ExecutionError):
        table.apply(operation, str(tmp_path / "s1"))
    monkeypatch.setattr(partitions, "move", move)
    assert table.apply(operation, str(tmp_path / "s1")) == Counts(2, 1, 0, 3)
    want = {k: (v, d, p) for k, v, d, p in first_rows()}
    assert contents(table, spark) == {**want, 3: ("new", 4, "x"), 500: ("added", 2, "a b"), 501: ("added", 9, "y")}
    assert table.apply(operation, str(tmp_path / "s1")) == Counts(2, 1, 0, 3)
    assert table.read(spark).count() == 62


@pytest.mark.parametrize("make", ["partitions", "buckets"])
def test_an_empty_source_is_checked_too(spark, tmp_path, make):
    path = str(tmp_path / "t")
    made = PartitionedTable(path, FIELDS, ("day",)) if make == "partitions" else BucketedTable(path, FIELDS, ("k",), 4)
    made.create(rows(spark, *first_rows()))
    nothing = rows(spark, (1, "x", 1, "y")).where("false")
    with pytest.raises(ConfigurationError, match="no_such_column"):
        made.apply(update(None, nothing, SPEC).update_columns("no_such_column"), str(tmp_path / "s1"))
    assert made.apply(update(None, nothing, SPEC), str(tmp_path / "s1")) == Counts()


def test_a_table_that_is_not_there_yet(spark, tmp_path):
    made = PartitionedTable(str(tmp_path / "t"), FIELDS, ("day",))
    assert made.apply(merge(None, rows(spark, (1, "x", 1, "y")), SPEC).sequence("n"), str(tmp_path / "s1")).inserted == 1
    assert contents(made, spark) == {1: ("x", 1, "y")}


def test_the_change_set_of_a_batch_is_delivered_once(spark, table, tmp_path, monkeypatch):
    operation = update(None, rows(spark, (3, "new", 1, "é")), SPEC).ordinal("n").output("v")
    told = str(tmp_path / "told")
    monkeypatch.setattr(partitions, "move", lambda *a: (_ for _ in ()).throw(ExecutionError("lost")))
    with pytest.raises(ExecutionError):
        table.apply(operation, str(tmp_path / "s1"), changes=told)
    times = {name: os.stat(os.path.join(told, name)).st_mtime_ns for name in os.listdir(told)}
    monkeypatch.undo()
    table.apply(operation, str(tmp_path / "s1"), changes=told)
    assert times == {name: os.stat(os.path.join(told, name)).st_mtime_ns for name in os.listdir(told)}
    assert [tuple(r) for r in spark.read.parquet(told).collect()] == [(0, "UPDATE", 3, "new")]


def test_a_stream_leaves_its_change_sets(spark, tmp_path):
    made = PartitionedTable(str(tmp_path / "t"), FIELDS, ("place",))
    for part, given in enumerate([[(1, "a", 1, "x"), (2, "b", 1, "y")], [(1, "c", 1, "y")]]):
        rows(spark, *given).coalesce(1).write.parquet(str(tmp_path / "in" / str(part)))
    stream = (
        spark.readStream.schema(rows(spark, (1, "a", 1, "x")).schema).option("maxFilesPerTrigger", 1)
        .parquet(str(tmp_path / "in" / "*"))
    )
    query = apply_stream(
        stream, made, lambda batch: merge(None, batch, SPEC).sequence("n", distinct_per_key=True).ordinal("n").output("v"),
        checkpoint=str(tmp_path / "c"), staging=str(tmp_path / "s"), changes=str(tmp_path / "told"),
    )
    query.awaitTermination()
    assert contents(made, spark) == {1: ("c", 1, "y"), 2: ("b", 1, "y")}
    told = spark.read.parquet(str(tmp_path / "told")).select("batch", "k", "action", "v").collect()
    assert sorted(map(tuple, told)) == [(0, 1, "INSERT", "a"), (0, 2, "INSERT", "b"), (1, 1, "UPDATE", "c")]


# ---------------------------------------------------------------- the catalog


@pytest.fixture(params=["plain", "partitions", "buckets", "both"])
def kept(request, spark, tmp_path):
    name = f"kept_{uuid.uuid4().hex}_{request.param}"
    writer = rows(spark, *first_rows()).select(*FIELDS.names).write.format("parquet")
    if request.param in ("partitions", "both"):
        writer = writer.partitionBy("day", "place")
    if request.param in ("buckets", "both"):
        writer = writer.bucketBy(4, "k").sortBy("k")
    writer.saveAsTable(name)
    yield TableSpec(name, keys=("k",))
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def stored(spark, spec):
    return {r.k: (r.v, r.day.day, r.place) for r in spark.table(spec.name).collect()}


def test_commit_keeps_partitions_and_buckets(spark, kept, tmp_path):
    want = {k: (v, d, p) for k, v, d, p in first_rows()}
    source = rows(spark, (3, "new", 7, "it's"), (500, "added", 2, "a b"), (4, "x", 1, None))
    assert merge(None, source, kept).sequence("n").commit(str(tmp_path / "v1")) == Counts(1, 2, 0, 3)
    want |= {3: ("new", 7, "it's"), 500: ("added", 2, "a b"), 4: ("x", 1, None)}
    assert stored(spark, kept) == want
    gone = rows(spark, *(r for r in first_rows() if r[3] == "é" and r[2] == 2), (3, "", 7, "it's"))
    chain = Chain(spark.table(kept.name)).then(delete(None, gone, kept))
    chain.commit(kept, str(tmp_path / "v2"))
    for k, _, _, _ in [r for r in first_rows() if r[3] == "é" and r[2] == 2] + [(3, 0, 0, 0)]:
        want.pop(k)
    assert stored(spark, kept) == want
    merge(None, rows(spark, (500, "last", 2, "a b")), kept).sequence("n").commit(str(tmp_path / "v3"))
    assert stored(spark, kept) == {**want, 500: ("last", 2, "a b")}
    other = spark.table(kept.name).alias("x").join(spark.table(kept.name).alias("y"), "k")
    assert other.count() == len(want)
    if kept.name.endswith("buckets"):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        try:
            assert "Exchange" not in other._jdf.queryExecution().executedPlan().toString()
        finally:
            spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert not [t.name for t in spark.catalog.listTables() if "draft" in t.name]


def test_a_refused_commit_leaves_the_table(spark, kept, tmp_path):
    before = stored(spark, kept)
    operation = update(None, rows(spark, (3, "x", 1, "y"), (999, "x", 1, "y")), kept).fail_on_mismatch()
    with pytest.raises(Exception, match="concurrency"):
        operation.commit(str(tmp_path / "v1"))
    assert stored(spark, kept) == before and not (tmp_path / "v1").exists()


def test_defaults_that_the_table_declares(spark):
    spark.sql("DROP TABLE IF EXISTS with_defaults")
    spark.sql("CREATE TABLE with_defaults (k BIGINT, v STRING DEFAULT 'none', w INT DEFAULT 40 + 2) USING parquet")
    spec = TableSpec("with_defaults", keys=("k",), defaults={"w": "7"})
    insert(None, spark.createDataFrame([(1,)], "k long"), spec).append()
    insert(None, spark.createDataFrame([(2,)], "k long"), TableSpec("with_defaults", keys=("k",))).append()
    nulls = spark.createDataFrame([(3, None, 1)], "k long, v string, w int")
    insert(None, nulls, spec).nulls_take_defaults().append()
    merged = merge(None, spark.createDataFrame([(4, 0)], "k long, n int"), TableSpec("with_defaults", keys=("k",))).sequence("n")
    got = {tuple(r) for r in merged.plan().snapshot.collect()}
    assert got == {(1, "none", 7), (2, "none", 42), (3, "none", 1), (4, "none", 42)}
    spark.sql("DROP TABLE with_defaults")
