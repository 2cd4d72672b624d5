"""Prefix sums and shards against brute force."""

from __future__ import annotations

import collections
import random
import zlib

import pytest
from pyspark.sql import functions as F

from rowtide.llm import sharding
from rowtide.llm.prefix import running

FIELDS = "doc_id long, text string, shard string, size int, _read int, carried string"


def expected(rows, shards):
    """(doc_id, size, crc, shard, slot) by one pass over the sorted rows."""
    sized = sorted(
        ((i is not None, i or 0, 8 + len(t.encode()), zlib.crc32(t.encode()), i) for i, t in ((r[0], r[1] or "") for r in rows))
    )
    whole, before, slots, out = sum(r[2] for r in sized), 0, collections.Counter(), []
    for _, _, size, crc, doc_id in sized:
        shard = (2 * before + size) * shards // (2 * whole)
        out.append((doc_id, size, crc, shard, slots[shard]))
        slots[shard] += 1
        before += size
    return out


def found(df):
    return [tuple(r) for r in df.select("doc_id", "size", "text_crc32", "shard", "slot").collect()]


def some_rows(count=400, seed=1):
    """A third of the rows repeat one id and text, another third one text; some are null, empty or very long."""
    rng = random.Random(seed)
    rows = []
    for n in range(count):
        kind = n % 6
        if kind < 2:
            row = (7, "hot copy")
        elif kind < 4:
            row = (n, "hot text")
        else:
            row = (rng.choice([n, None]), rng.choice([None, "", "äöü 漢字", "x" * rng.randrange(5000)]))
        rows.append((*row, "s", n, n, "c"))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("shards", [1, 7, 24])
def test_shards_equal_one_pass(spark, shards):
    rows = some_rows()
    df = spark.createDataFrame(rows, FIELDS).repartition(5)
    assert sorted(found(sharding.sharded(df, shards)), key=str) == sorted(expected(rows, shards), key=str)


def test_shards_are_near_their_target(spark):
    df = spark.createDataFrame(some_rows(900), FIELDS)
    by_shard = collections.Counter()
    rows = found(sharding.sharded(df, 6))
    for _, size, _, shard, _ in rows:
        by_shard[shard] += size
    target, largest = sum(by_shard.values()) / 6, max(r[1] for r in rows)
    assert set(by_shard) == set(range(6))
    assert all(abs(size - target) <= largest for size in by_shard.values())


def test_empty_and_small_tables(spark):
    assert found(sharding.sharded(spark.createDataFrame([], FIELDS), 24)) == []
    one = spark.createDataFrame([(None, None, "s", 1, 1, "c")], FIELDS)
    assert found(sharding.sharded(one, 24)) == [(None, 8, 0, 12, 0)]


def test_written_shards_hold_every_row_and_column(spark, tmp_path):
    rows = some_rows(120)
    df = spark.createDataFrame(rows, FIELDS)
    shard, slot = sharding.write_shards(df, str(tmp_path / "out"), 5)
    assert (shard, slot) == ("shard_", "slot")
    back = spark.read.schema(f"{FIELDS}, slot long, shard_ int").parquet(str(tmp_path / "out"))
    assert collections.Counter(tuple(r) for r in back.select(*df.columns).collect()) == collections.Counter(rows)
    for number, in back.select(shard).distinct().collect():
        slots = sorted(r[0] for r in back.where(F.col(shard) == number).select(slot).collect())
        assert slots == list(range(len(slots)))


def test_the_plan_runs_no_python(spark):
    plan = sharding.sharded(spark.createDataFrame(some_rows(20), FIELDS), 3)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_running_sums_by_group(spark):
    rows = [(("a", "b", "")[n % 3], n % 7, n) for n in range(100)]
    df = spark.createDataFrame(rows, "g string, k int, w long").repartition(4)
    got = running(df, ("k",), within=("g",), weight="w").collect()
    for name in ("a", "b", ""):
        mine = sorted((r for r in got if r["g"] == name), key=lambda r: r["place"])
        assert [r["place"] for r in mine] == list(range(len(mine)))
        assert [r["k"] for r in mine] == sorted(r["k"] for r in mine)
        before = 0
        for r in mine:
            assert (r["before"], r["group_rows"], r["group_weight"]) == (before, len(mine), sum(m["w"] for m in mine))
            before += r["w"]
