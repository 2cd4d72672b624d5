"""Row ordinals, generated ids and row versions."""

from __future__ import annotations

import json
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowtide.plans.roles import ORDINAL
from rowtide.session import frozen, observed

# monotonically_increasing_id puts the partition number above this many bits of row position.
_ROW_BITS = (1 << 33) - 1

_PART = "__part"

# Partitions whose sizes are taken while the rows are frozen. Merging a histogram takes as long as it has bins, so more
# are counted by a job of their own.
COUNTED_ON_THE_WAY = 1000


def with_ordinal(source: DataFrame, order_by: str | None = None, name: str = ORDINAL) -> DataFrame:
    """``source`` with a dense number from 0 in ``name``: by ``order_by``, else as the rows are read.

    The rows are range-partitioned (ties are spread by input partition, so that one value may fill
    any share of the rows), frozen on shared storage, and numbered from the row count of each
    partition. The driver sees one count per partition, and no window spans the whole source. The
    starts of the partitions reach the rows as a constant, so the optimizer still knows how large the source is.
    """
    seen = None
    if order_by is not None:
        partitions = int(source.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        source = (
            source.withColumn(_PART, F.spark_partition_id())
            .repartitionByRange(partitions, order_by, _PART)
            .sortWithinPartitions(order_by)
            .withColumn(_PART, F.spark_partition_id())
        )
        if partitions <= COUNTED_ON_THE_WAY:
            # A histogram with a bin per partition is exact.
            seen = Observation()
            source = source.observe(seen, F.histogram_numeric(_PART, F.lit(partitions)).alias("sizes"))
        source = source.drop(_PART)
    fixed = frozen(source)
    part = F.spark_partition_id()
    if seen is not None:
        sizes = {int(bar["x"]): int(bar["y"]) for bar in observed(seen).get("sizes") or ()}
    else:
        sizes = dict(fixed.groupBy(part.alias(_PART)).count().collect())
    counts = [sizes.get(n, 0) for n in range(max(sizes, default=-1) + 1)]
    starts = F.from_json(F.lit(json.dumps([0, *accumulate(counts)])), "array<bigint>")
    position = F.monotonically_increasing_id().bitwiseAND(F.lit(_ROW_BITS))
    return fixed.withColumn(name, F.element_at(starts, part + 1) + position)


def next_value(target: DataFrame, name: str) -> Column:
    """One more than the largest value of a column, as a scalar subquery."""
    largest = target.agg(F.max(name).cast("long").alias("largest")).scalar()
    return F.coalesce(largest, F.lit(0)) + F.lit(1)


def generated_id(target: DataFrame, name: str, data_type: T.DataType) -> Column:
    """A new id per source row: beyond every id in the table, distinct because ordinals are.

    Rows that are not inserted leave gaps.
    """
    return (next_value(target, name) + F.col(ORDINAL)).cast(data_type)
