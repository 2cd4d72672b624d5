"""Connected components of links between ids, on shared storage between rounds."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowtide.session import frozen

#: Pieces over which the rows of one value are spread.
SALTS = 8
#: Links that one task puts together; more take rounds of shuffles.
FEW = 200_000


def salt(of: str) -> Column:
    return F.pmod(F.xxhash64(of), F.lit(SALTS)).alias("salt")


def salts() -> Column:
    return F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))).alias("salt")


def contracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The links of one partition as ``(id, smallest id it reaches here)``."""
    up: dict[int, int] = {}

    def root(i: int) -> int:
        top = i
        while (above := up.setdefault(top, top)) != top:
            top = above
        while up[i] != top:
            up[i], i = top, up[i]
        return top

    for batch in batches:
        for a, b in zip(batch["a"].to_pylist(), batch["b"].to_pylist(), strict=True):
            a, b = root(a), root(b)
            if a != b:
                up[max(a, b)] = min(a, b)
    pairs = np.array([(i, root(i)) for i in up if up[i] != i], np.int64).reshape(-1, 2)
    yield pa.record_batch({"a": pa.array(pairs[:, 0]), "b": pa.array(pairs[:, 1])})


def components(links: DataFrame) -> DataFrame:
    """``id, component`` (the smallest id reached) of every id in ``links (a long, b long)``.

    Links that fit a task are put together by one. Of more, every partition first replaces its links by links to the smallest ids
    they reach, no more than it has ids; in each round an id then meets all ids it is linked to, spread over a few partitions where these
    are many, and the same is done. Rounds stop when every id has one link and that leads to an id that has none, or when the links fit a
    task. Nothing is collected.
    """
    links = frozen(links.select("a", "b").where("a <> b"))
    if links.count() > FEW:
        links = frozen(links.mapInArrow(contracted, "a long, b long"))
    while True:
        left = links.count()
        if left <= FEW:
            # No shuffle: few links need no more than one task.
            links = frozen(links.coalesce(1).mapInArrow(contracted, "a long, b long"))
            return links.union(links.select("b", "b").distinct()).toDF("id", "component")
        both = links.union(links.select("b", "a")).distinct().repartition("a", salt("b"))
        links = frozen(both.mapInArrow(contracted, "a long, b long").distinct())
        ends = links.union(links.select("b", F.lit(None)))
        seen = ends.groupBy("a").agg(F.min("b").alias("low"), F.max("b").alias("high"), F.count("*").alias("rows"), F.count("b").alias("leaves"))
        if seen.where("low < high or (leaves > 0 and leaves < rows)").isEmpty():
            return links.union(links.select("b", "b")).distinct().toDF("id", "component")
