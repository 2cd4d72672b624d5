"""Helpers that several operators share."""

from __future__ import annotations

import ctypes
import sys
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def id_hash(id_col: str, modulus: int) -> Column:
    """``crc32(id as text) mod modulus``, the fold of a row."""
    return F.crc32(F.col(id_col).cast("string")) % modulus


def held(key: str, make: Callable):
    """One object per Python worker, kept between its tasks (modules of this package are not)."""
    kept = vars(sys.modules["pyspark"]).setdefault("_rowtide_llm_held", {})
    if key not in kept:
        kept[key] = make()
    return kept[key]


def let_go(key: str) -> None:
    """Frees what ``held`` keeps under the key, for stages that need it no more."""
    if vars(sys.modules["pyspark"]).get("_rowtide_llm_held", {}).pop(key, None) is not None:
        released()


def released() -> None:
    """Gives memory that is free back to the system: workers live on, and the next stage's have to fit beside them."""
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
        trim(0)


def lean(work: Callable) -> Callable:
    """``work`` on a group; memory is given back when it is done."""

    def run(table: pa.Table) -> pa.Table:
        out = work(table)
        released()
        return out

    return run


def lean_rows(work: Callable) -> Callable:
    """``work`` on batches; memory is given back at their end."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from work(batches)
        released()

    return run


def first_by_hash(df: DataFrame, group: str, limits: Column, seed: int, id_col: str = "doc_id") -> DataFrame:
    """Of each group the ids that come first by a hash, as many as ``limits`` says, one row for each.

    Ids whose hash is beyond three times the share of the group that is wanted cannot be among these, but
    for chance, and go before anything is sorted; so one task ranks a few times the sample, however large the
    group is.
    """
    place = F.pmod(F.xxhash64(F.col(id_col), F.lit(seed)), F.lit(1 << 40)) / float(1 << 40)
    counts = df.groupBy(group).agg(F.approx_count_distinct(id_col).alias("_ids"))
    near = df.withColumn("_place", place).join(counts, group).where(F.col("_place") * F.col("_ids") <= 3 * limits)
    near = near.dropDuplicates([group, id_col])  # before one task sorts them
    order = Window.partitionBy(group).orderBy("_place", id_col)
    ranked = near.withColumn("_rank", F.row_number().over(order))
    return ranked.where(F.col("_rank") <= limits).drop("_place", "_ids", "_rank")
