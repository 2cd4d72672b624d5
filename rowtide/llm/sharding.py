"""Contiguous shards of equal byte size: global prefix sums of the sizes, cut at equal targets.

DataFrame functions only: no Python runs in a task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowtide.llm.prefix import running

#: Bytes that a document takes besides its text, so that empty documents have a size too.
OVERHEAD = 8
#: Order of the documents over all shards.
ORDER = ("doc_id", "size", "text_crc32")


def sharded(
    docs: DataFrame, shards: int, id_col: str = "doc_id", text_col: str = "text", carry: Sequence[str] = ()
) -> DataFrame:
    """Every row of ``docs`` with its shard: ``doc_id, size, text_crc32, shard int, slot long`` and, with ``carry``,
    a struct ``carried`` of these columns.

    Rows are ordered by id (nulls first), size and text hash. With S the sum of the sizes before a row, T of all
    sizes, a row of size s goes to shard ``floor((2 S + s) * shards / (2 T))``: the cut that lies nearest to an equal
    target, so no shard is off ``T / shards`` by more than the largest row. ``slot`` numbers the rows of a shard
    from 0 without a gap.

    A null text has no bytes (size 8, hash 0), as an empty one. Rows that repeat an id, a text or both are rows of
    their own; a cut may fall between them, so neither is a hot spot. An empty table gives no rows, and a table with
    fewer rows than shards leaves shards empty. Other columns are ignored unless carried; their names may be any.
    """
    text = F.col(f"`{text_col}`")
    rows = docs.select(
        F.col(f"`{id_col}`").alias("doc_id"),
        (F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + OVERHEAD).alias("size"),
        F.coalesce(F.crc32(text), F.lit(0)).alias("text_crc32"),
        *([F.struct(*(F.col(f"`{name}`") for name in carry)).alias("carried")] if carry else []),
    )
    summed = running(rows, ORDER, weight="size")
    middle = (F.col("before") * 2 + F.col("size")) * F.lit(shards)
    placed = summed.withColumn("target", middle).select(
        *rows.columns, "place", F.expr("int(target div (2 * group_weight))").alias("shard"),
    )
    first = placed.groupBy("shard").agg(F.min("place").alias("first"))
    # One row per shard.
    return placed.join(F.broadcast(first), "shard").select(
        *rows.columns, "shard", (F.col("place") - F.col("first")).alias("slot"),
    )


def write_shards(
    docs: DataFrame, folder: str, shards: int, id_col: str = "doc_id", text_col: str = "text"
) -> tuple[str, str]:
    """Write all columns of ``docs`` as Parquet, a folder per shard; returns the names of the shard and slot columns.

    These are ``shard`` and ``slot``, with underscores added where ``docs`` has such columns.
    """
    taken = {name.lower() for name in docs.columns}
    names = []
    for name in ("shard", "slot"):
        while name in taken:
            name += "_"
        names.append(name)
    placed = sharded(docs, shards, id_col, text_col, carry=docs.columns)
    whole = placed.select("carried.*", F.col("shard").alias(names[0]), F.col("slot").alias(names[1]))
    whole.write.partitionBy(names[0]).parquet(folder)
    return names[0], names[1]
