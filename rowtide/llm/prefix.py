"""Dense numbers and prefix sums over a whole table, from the totals of its range partitions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rowtide.session import frozen


def running(
    rows: DataFrame, order: Sequence[str], within: Sequence[str] = (), weight: str | None = None
) -> DataFrame:
    """``rows`` with their place in ``order``, from 0, in each group of equal ``within``.

    Adds ``place`` and ``group_rows``, and with ``weight`` also ``before`` (its sum over the rows in front) and
    ``group_weight``. Rows that are equal in ``order`` keep the order in which they were read.

    The rows are frozen as they are read, then dealt into ranges of group, order and reading position, so that
    neither a group nor a repeated value has to fit into one task. Every range sums up its part of each group; the
    sums before a range, one row per group and range, are added to the numbers that the range gives its own rows.
    ``rows`` is read once and should be narrow; a null in ``within`` must have been replaced.
    """
    within = list(within)
    read = frozen(rows.withColumn("_read", F.monotonically_increasing_id()))
    ranges = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = read.repartitionByRange(ranges, *within, *order, "_read")
    fixed = frozen(dealt.withColumn("_range", F.spark_partition_id()))

    added: dict[str, Column] = {"place": F.lit(1), "before": F.col(weight)} if weight else {"place": F.lit(1)}
    wholes = {"place": "group_rows", "before": "group_weight"}
    sums = fixed.groupBy(*within, "_range").agg(*(F.sum(value).alias(name) for name, value in added.items()))
    groups = Window.partitionBy(*within)
    ahead = groups.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select(
        *within, "_range",
        *(F.coalesce(F.sum(name).over(ahead), F.lit(0)).alias(f"_{name}") for name in added),
        *(F.sum(name).over(groups).alias(wholes[name]) for name in added),
    )
    if not within:
        starts = F.broadcast(starts)  # one row per range
    own = Window.partitionBy(*within, "_range").orderBy(*order, "_read").rowsBetween(Window.unboundedPreceding, 0)
    counted = fixed.withColumns({name: F.sum(value).over(own) - value for name, value in added.items()})
    joined = counted.join(starts, [*within, "_range"])
    return joined.select(
        *rows.columns,
        *((F.col(name) + F.col(f"_{name}")).alias(name) for name in added), *(wholes[name] for name in added),
    )
