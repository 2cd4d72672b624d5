"""Vector columns: which rows take part, tiles of queries against shards of rows, merging of top lists."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

FAN_IN = 16


def usable(df: DataFrame, id_col: str, vector_col: str, nonzero: bool) -> DataFrame:
    """``(vec_id, vector)`` of the rows that take part, one row per id.

    Left out: null ids, null or empty vectors, vectors with a null or non-finite component and,
    with ``nonzero``, vectors of zeros. Rows that repeat an id are one vector, the smallest of them.
    """
    vector = F.col("vector")

    def finite(x: Column) -> Column:
        return F.coalesce(~F.isnan(x) & (F.abs(x) != float("inf")), F.lit(False))

    rows = df.select(
        F.col(f"`{id_col}`").cast("long").alias("vec_id"),
        F.col(f"`{vector_col}`").cast("array<double>").alias("vector"),
    ).where(F.col("vec_id").isNotNull() & (F.size(vector) > 0) & F.forall(vector, finite))
    if nonzero:
        rows = rows.where(F.exists(vector, lambda x: x != 0))
    return rows.groupBy("vec_id").agg(F.min("vector").alias("vector"))


def blocks(table: pa.Table, id_col: str, vector_col: str) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """The rows of a table by vector length: length, ids in ascending order, matrix."""
    if not table.num_rows:  # such a table may have no columns
        return
    ids = table[id_col].to_numpy()
    column = table[vector_col].combine_chunks()
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks)
    ends = column.offsets.to_numpy()
    flat = column.values.to_numpy(zero_copy_only=False)
    lengths = np.diff(ends)
    for length in np.unique(lengths):
        rows = np.flatnonzero(lengths == length)
        rows = rows[np.argsort(ids[rows], kind="stable")]
        yield int(length), ids[rows], flat[ends[rows][:, None] + np.arange(length)]


def against_shards(
    rows: DataFrame,
    queries: DataFrame,
    search: Callable[[np.ndarray, np.ndarray, np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray, np.ndarray]],
    score_type: str,
    shard_rows: int,
    tile_rows: int,
) -> tuple[DataFrame, int]:
    """``search(query ids, queries, row ids, rows)`` for every tile of queries and shard of rows.

    Rows and queries are dealt by a hash of their id, about ``shard_rows`` and ``tile_rows`` together,
    and each pair of a tile and a shard is one group: what a task holds does not grow with the data.
    Also returns the number of shards.
    """
    shards = max(1, -(-rows.count() // shard_rows))
    tiles = max(1, -(-queries.count() // tile_rows))
    dealt = rows.select(
        "vec_id", "vector", F.pmod(F.xxhash64("vec_id"), F.lit(shards)).alias("shard"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.lit(tiles - 1).cast("long"))).alias("tile"),
    )
    asked = queries.select(
        F.col("vec_id").alias("asked_id"), F.col("vector").alias("asked_vector"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.lit(shards - 1).cast("long"))).alias("to_shard"),
        F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(tiles)).alias("of_tile"),
    )

    def pair(keys, left: pa.Table, right: pa.Table) -> pa.Table:
        found = [[np.empty(0, np.int64)], [np.empty(0, np.int64)], [np.empty(0)]]
        wanted = {length: (ids, matrix) for length, ids, matrix in blocks(right, "asked_id", "asked_vector")}
        for length, ids, matrix in blocks(left, "vec_id", "vector"):
            if length in wanted:
                for column, values in zip(found, search(*wanted[length], ids, matrix), strict=True):
                    column.append(values)
        query_id, vec_id, score = (np.concatenate(c) for c in found)
        kind = pa.int64() if score_type == "long" else pa.float64()
        return pa.table({
            "query_id": pa.array(query_id, pa.int64()), "vec_id": pa.array(vec_id, pa.int64()),
            "score": pa.array(score.astype(np.int64) if score_type == "long" else score, kind),
            "shard": pa.array(np.full(len(query_id), keys[0].as_py(), np.int64)),
        })

    found = dealt.groupBy("shard", "tile").cogroup(asked.groupBy("to_shard", "of_tile")).applyInArrow(
        pair, f"query_id long, vec_id long, score {score_type}, shard long"
    )
    return found, shards


def merged(found: DataFrame, shards: int, k: int, largest: bool) -> DataFrame:
    """The ``k`` best of each query, from the lists of its shards: a tree with a fan-in of 16."""
    order = [F.col("score").desc() if largest else F.col("score").asc(), F.col("vec_id").asc()]

    def best(df: DataFrame, *keys: str) -> DataFrame:
        ranked = df.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
        return ranked.where(F.col("rank") <= k)

    while shards > FAN_IN:
        shards = -(-shards // FAN_IN)
        found = best(found.withColumn("shard", F.floor(F.col("shard") / FAN_IN)), "query_id", "shard").drop("rank")
    return best(found, "query_id").select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
