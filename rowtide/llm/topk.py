"""Exact top-k search: tiled matrix products, partial selection per tile, tree merging of the lists."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame

from rowtide.llm.vectors import against_shards, merged, usable

#: Queries that one matrix product scores at a time.
STEP = 256


def inner_products(queries: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Exact integer products: in doubles where no sum can leave 2**53, in Python's integers beyond."""
    most = np.abs(queries).max() * np.abs(rows).max() * queries.shape[1]
    if most < 2**53:
        return queries @ rows.T
    whole = [np.array([[int(x) for x in r] for r in m], dtype=object) for m in (queries, rows)]
    return whole[0] @ whole[1].T


def select(scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Row and column of the ``k`` highest of each row; of equal scores the first columns."""
    n = scores.shape[1]
    if n <= k:
        return np.divmod(np.arange(scores.size), n)
    bar = np.partition(scores, n - k, axis=1)[:, n - k]
    line, column = np.nonzero(scores >= bar[:, None])
    above = scores[line, column] > bar[line]
    # Rank the ties behind what is above the bar; nonzero gives both in column order.
    order = np.lexsort((column, ~above, line))
    line, column = line[order], column[order]
    place = np.arange(len(line)) - np.searchsorted(line, line)
    return line[place < k], column[place < k]


def exact_top_k(
    df: DataFrame, is_query: Column, k: int, scale: float = 256.0, id_col: str = "vec_id",
    vector_col: str = "embedding", shard_rows: int = 4096, tile_rows: int = 2048,
) -> DataFrame:
    """The ``k`` rows with the highest integer inner product with each query.

    Components count as ``floor(scale * x)``. Queries are the rows for which ``is_query`` (over
    ``vec_id``) holds; candidates are all rows but the query's own, of the query's length. Returns
    ``query_id long, rank int, vec_id long, score long``, ties to the smaller id; all candidates, if fewer. A
    score that a long cannot hold stops the job.

    Null ids and vectors that are null, empty, or hold a null or non-finite component take no part.
    Rows that repeat an id are one vector (the smallest). Repeated vectors are ties. An empty table
    gives no rows. Other columns are ignored.
    """
    rows = usable(df, id_col, vector_col, nonzero=False)

    def search(query_ids, queries, row_ids, matrix):
        whole = np.floor(scale * matrix)
        out = [], [], []
        for at in range(0, len(query_ids), STEP):
            ids = query_ids[at:at + STEP]
            scores = inner_products(np.floor(scale * queries[at:at + STEP]), whole)
            # One more than asked for: the query's own row may be among them.
            line, column = select(scores, k + 1)
            other = ids[line] != row_ids[column]
            line, column = line[other], column[other]
            out[0].append(ids[line])
            out[1].append(row_ids[column])
            out[2].append(scores[line, column].astype(np.int64))
        return tuple(np.concatenate(x) for x in out)

    found, shards = against_shards(rows, rows.where(is_query), search, "long", shard_rows, tile_rows)
    return merged(found, shards, k, largest=True)
