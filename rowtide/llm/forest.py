"""Approximate nearest neighbours by a hash-prefix forest of sorted arrays."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame

from rowtide.llm.vectors import against_shards, merged, usable

BITS = 64


class Forest:
    """Sorted arrays of 64-bit hash strings, one per tree, over the rows of one shard.

    A bit is the side of a random hyperplane through the shard's mean. Rows that share a prefix stand
    together in a tree, so that the matches of any prefix length are one slice.
    """

    def __init__(self, rows: np.ndarray, trees: int, seed: int):
        rng = np.random.default_rng(seed)
        self.centre = rows.mean(axis=0)
        self.planes = rng.standard_normal((trees, rows.shape[1], BITS))
        self.order, self.keys = [], []
        for keys in self.hashed(rows):
            order = np.argsort(keys, kind="stable")
            self.order.append(order)
            self.keys.append(keys[order])

    def hashed(self, vectors: np.ndarray) -> list[np.ndarray]:
        moved = vectors - self.centre
        return [
            np.packbits(moved @ planes > 0, axis=1).view(">u8").ravel().astype(np.uint64)
            for planes in self.planes
        ]

    def matches(self, queries: np.ndarray, enough: int) -> tuple[np.ndarray, np.ndarray]:
        """Per query and tree, the slice of the longest prefix at which all trees together give enough.

        Each tree is descended to the query's own place; all trees then ascend together, one bit at a
        time, until their slices hold ``enough`` rows. A slice is never cut.
        """
        trees = self.hashed(queries)
        low = np.zeros((len(queries), len(trees)), np.int64)
        high = np.full_like(low, len(self.order[0]))
        open_ = np.arange(len(queries))
        for length in range(BITS, 0, -1):
            rest = np.uint64((1 << (BITS - length)) - 1)
            for t, keys in enumerate(trees):
                first = keys[open_] & ~rest
                low[open_, t] = np.searchsorted(self.keys[t], first, "left")
                high[open_, t] = np.searchsorted(self.keys[t], first | rest, "right")
            open_ = open_[(high[open_] - low[open_]).sum(axis=1) < enough]
            if not len(open_):
                return low, high
        low[open_], high[open_] = 0, len(self.order[0])
        return low, high


def nearest(
    df: DataFrame, is_query: Column, k: int, id_col: str = "vec_id", vector_col: str = "embedding",
    trees: int = 16, share: float = 1.0, least: int = 512, seed: int = 7,
    shard_rows: int = 8192, tile_rows: int = 1024,
) -> DataFrame:
    """The ``k`` nearest rows found for each query, by Euclidean distance in double precision.

    Every shard of about ``shard_rows`` rows has its own forest. A query takes from each shard what the
    trees hold under its longest prefixes, ascending until they hold ``share`` of the shard's rows and
    at least ``least``, counted with repeats over trees; these candidates are measured exactly. Queries
    are the rows for which ``is_query`` (over ``vec_id``) holds; candidates are all rows but the query's
    own, of the query's length. Returns ``query_id long, rank int, vec_id long, score double``,
    nearest first, ties to the smaller id; all candidates, if fewer.

    Null ids and vectors that are null, empty, zero, or hold a null or non-finite component take no
    part. Rows that repeat an id are one vector (the smallest). Equal vectors have equal hash strings and
    come together, however many. An empty table gives no rows. Other columns are ignored.
    """
    rows = usable(df, id_col, vector_col, nonzero=True)

    def search(query_ids, queries, row_ids, matrix):
        forest = Forest(matrix, trees, seed)
        low, high = forest.matches(queries, max(least, int(share * len(row_ids))))
        out = [], [], []
        for i, query_id in enumerate(query_ids):
            taken = np.zeros(len(row_ids), bool)
            for t, order in enumerate(forest.order):
                taken[order[low[i, t]:high[i, t]]] = True
            near = np.flatnonzero(taken & (row_ids != query_id))
            apart = matrix[near] - queries[i]
            distance = np.sqrt((apart * apart).sum(axis=1))
            if len(near) > k:
                bar = np.partition(distance, k - 1)[k - 1]
                near, distance = near[distance <= bar], distance[distance <= bar]
            best = np.lexsort((near, distance))[:k]
            out[0].append(np.full(len(best), query_id, np.int64))
            out[1].append(row_ids[near[best]])
            out[2].append(distance[best])
        return tuple(np.concatenate(x) for x in out)

    found, shards = against_shards(rows, rows.where(is_query), search, "double", shard_rows, tile_rows)
    return merged(found, shards, k, largest=False)
