"""Key joins that hold up when one key owns a large share of the rows.

Every join here is an equality join whose right side holds each key at most once. Nothing is ever
broadcast on a guess: a side is either small by the optimizer's own size estimate, in which case
Spark decides as it does for any join, or it is bounded by construction (``hot_keys``).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from rowtide.session import frozen, observed

FAN = "__fan"
SALT = "__salt"
PIECE = "__piece"
HOT = "__hot_"

# Below this size a shuffle is cheaper than the further stages that would avoid it.
LARGE = 256 * 1024 * 1024

# A key is only worth splitting when it is large in absolute terms too.
SMALLEST_HOT_KEY = 1_000_000

# Sampled rows of a key that fills one shuffle partition, bytes of a stored key, and the share of
# rows to sample when the size is anyone's guess.
SAMPLE_PER_SHARE = 1000
KEY_BYTES = 16
SMALLEST_SAMPLE = 0.001


def estimated_bytes(df: DataFrame) -> int | None:
    """The optimizer's size estimate of ``df``, or ``None`` where it is not available."""
    plan = getattr(df, "_jdf", None)
    if plan is None:
        return None
    return int(str(plan.queryExecution().optimizedPlan().stats().sizeInBytes()))


def fits_broadcast(df: DataFrame) -> bool:
    """Whether Spark itself would broadcast ``df`` as the inner side of a join."""
    estimate = estimated_bytes(df)
    return estimate is not None and estimate <= _broadcast_limit(df.sparkSession)


def is_large(df: DataFrame) -> bool:
    """Whether shuffling ``df`` costs more than reading its keys a second time."""
    estimate = estimated_bytes(df)
    return estimate is None or estimate > LARGE


def _broadcast_limit(spark: SparkSession) -> int:
    return spark._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()


def equal(left: DataFrame, right: DataFrame, pairs: Sequence[tuple[str, str]]) -> Column:
    """The conjunction of column equalities between the two sides."""
    return reduce(and_, (left[mine] == right[theirs] for mine, theirs in pairs))


def hot_keys(df: DataFrame, keys: Sequence[str], floor: int | None = None) -> DataFrame | None:
    """Keys that hold more than one shuffle partition's share of ``df``, and into how many pieces
    to split each; ``None`` if there are none.

    With P shuffle partitions fewer than P keys can hold more than 1 / P of the rows, whatever the
    data looks like, and their pieces add up to less than 2 P. A sample of the key columns that
    gives such a key about a thousand rows is enough to find them. The list is frozen, so that both
    sides of a join see the same one.
    """
    floor = SMALLEST_HOT_KEY if floor is None else floor
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    key_columns = df.select(*keys)
    fraction = _sample_fraction(key_columns, partitions)
    seen = Observation()
    sample = key_columns.sample(fraction, seed=1).observe(seen, F.count(F.lit(1)).alias("rows"))
    least = max(floor * fraction, SAMPLE_PER_SHARE / 2 if fraction < 1 else 0)
    counted = sample.groupBy(*keys).agg(F.count(F.lit(1)).alias("__rows"))
    large = frozen(counted.where(F.col("__rows") > least))
    share = F.col("__rows") * F.lit(partitions / max(observed(seen).get("rows", 0), 1))
    hot = large.where(share > 1).select(
        *(F.col(name).alias(f"{HOT}{name}") for name in keys), F.ceil(share).cast("int").alias(FAN)
    )
    return None if hot.isEmpty() else hot


def _sample_fraction(key_columns: DataFrame, partitions: int) -> float:
    estimate = estimated_bytes(key_columns)
    if not estimate:
        return 1.0
    return min(1.0, max(SMALLEST_SAMPLE, SAMPLE_PER_SHARE * partitions * KEY_BYTES / estimate))


def join_on_keys(
    left: DataFrame,
    right: DataFrame,
    pairs: Sequence[tuple[str, str]],
    how: str,
    left_is_unique: bool,
    find: Callable[[Sequence[str]], DataFrame | None] | None = None,
    floor: int | None = None,
    only: Callable[[DataFrame], Column] | None = None,
) -> DataFrame:
    """``left`` joined to ``right``, which holds each key once.

    A small right side is broadcast by Spark, and unique keys cannot be skewed. Otherwise the hot
    keys of the left side are looked for, which starts a job; if there are any, they are spread over
    several partitions and their few right-hand rows are repeated to meet them. ``find`` may know them already. ``only`` says which left rows may
    meet any.
    """
    only = only or (lambda rows: F.lit(True))
    left_keys = [mine for mine, _ in pairs]
    find = find or (lambda keys: hot_keys(left, keys, floor))
    hot = None if left_is_unique or fits_broadcast(right) else find(left_keys)
    if hot is None:
        return left.join(right, equal(left, right, pairs) & only(left), how)
    spread = _spread_left(left, left_keys, hot)
    repeated = _repeat_right(right, pairs, hot)
    met = equal(spread, repeated, pairs) & (spread[PIECE] == repeated[SALT]) & only(spread)
    return spread.join(repeated, met, how).drop(PIECE, SALT)


def _spread_left(left: DataFrame, keys: Sequence[str], hot: DataFrame) -> DataFrame:
    # The input partition number spreads even identical copies, and a retried task sees the same.
    numbered = left.withColumn("__part", F.spark_partition_id())
    found = _same_hot_key(numbered, hot, [(name, name) for name in keys])
    piece = F.pmod(F.col("__part"), F.coalesce(F.col(FAN), F.lit(1))).alias(PIECE)
    return numbered.join(F.broadcast(hot), found, "left").select(*left.columns, piece)


def _repeat_right(right: DataFrame, pairs: Sequence[tuple[str, str]], hot: DataFrame) -> DataFrame:
    found = _same_hot_key(right, hot, [(theirs, mine) for mine, theirs in pairs])
    pieces = F.sequence(F.lit(0), F.coalesce(F.col(FAN), F.lit(1)) - 1)
    return right.join(F.broadcast(hot), found, "left").select(
        *right.columns, F.explode(pieces).alias(SALT)
    )


def _same_hot_key(side: DataFrame, hot: DataFrame, pairs: Sequence[tuple[str, str]]) -> Column:
    # Null-safe: null keys need spreading too.
    return reduce(and_, (side[own].eqNullSafe(hot[f"{HOT}{name}"]) for own, name in pairs))


def missing_from(
    source: DataFrame,
    target: DataFrame,
    pairs: Sequence[tuple[str, str]],
    source_is_unique: bool,
    target_is_unique: bool,
    asked: DataFrame | None = None,
) -> DataFrame:
    """Rows of ``source`` whose key does not occur in ``target``. ``pairs`` are (source, target).

    The target is read for its key columns only. For a small source the target keys are first cut
    down to those the source mentions, which needs no shuffle of the target. ``asked`` may name the
    same keys more cheaply than ``source``, repeats included.
    """
    theirs = [name for _, name in pairs]
    keys = target.select(*theirs)
    wanted = (asked or source).select(*(F.col(mine).alias(f"__want_{i}") for i, (mine, _) in enumerate(pairs)))
    if fits_broadcast(wanted) and not fits_broadcast(keys):
        met = equal(keys, wanted, [(name, f"__want_{i}") for i, name in enumerate(theirs)])
        present = keys.join(wanted, met, "left_semi").distinct()
        # No more rows than the small source has keys.
        bounded = F.broadcast(present)
        return source.join(bounded, equal(source, present, pairs), "left_anti")
    present = keys if target_is_unique else keys.distinct()
    return join_on_keys(source, present, pairs, "left_anti", source_is_unique)
