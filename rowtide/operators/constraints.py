"""Rows that would break a table's declared rules."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowtide.operators.duplicates import duplicate_keys
from rowtide.operators.staging import violation
from rowtide.plans.joins import fits_broadcast
from rowtide.spec import TableSpec

# Size of the filter of touched values, and how many there may be for it to be broadcast.
BITS_PER_VALUE = 16
MOST_FILTERED = 4_000_000


def constraint_rejects(source: DataFrame, spec: TableSpec) -> DataFrame:
    """Source rows that hold a null where a value is required, or a value that is too long."""
    broken = [violation(F.col(name), name, spec) for name in source.columns]
    broken = [condition for condition in broken if condition is not None]
    return source.where(reduce(lambda a, b: a | b, broken)) if broken else source.where(F.lit(False))


def unique_violations(snapshot: DataFrame, changed: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Values of a unique column group that more than one row of ``snapshot`` holds.

    Only values among the ``changed`` rows can be new violations. For a small change only rows with
    those values are counted, which is a scan of the snapshot without a shuffle. For a larger one a Bloom filter of the
    values is broadcast first, and what passes it is shuffled. Nulls count as equal.
    """
    touched = changed.select(*(F.col(name).alias(f"__new_{name}") for name in columns))
    met = reduce(
        lambda a, b: a & b, (F.col(name).eqNullSafe(F.col(f"__new_{name}")) for name in columns)
    )
    if fits_broadcast(touched):
        return duplicate_keys(snapshot.select(*columns).join(touched, met, "left_semi"), columns)
    # Counting first combines equal values before the shuffle, so no value is too hot to join.
    maybe = _possibly_among(snapshot.select(*columns), touched, columns)
    return duplicate_keys(maybe, columns).join(touched.distinct(), met, "left_semi")


def _possibly_among(values: DataFrame, touched: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The rows of ``values`` that pass a Bloom filter with one hash of the ``touched`` ones: these, and one in
    ``BITS_PER_VALUE`` of the others.

    The filter is a table of 64-bit words, four touched values to a word. Beyond ``MOST_FILTERED`` values it would
    not be small any more, and the change is no longer small beside the table: all rows pass.
    """
    count = touched.count()
    if count > MOST_FILTERED:
        return values
    bits = max(count, 1) * BITS_PER_VALUE

    def place(names: Sequence[str]) -> Column:
        return F.pmod(F.xxhash64(*names), F.lit(bits))

    marks = touched.select(place(touched.columns).alias("__at"))
    words = marks.groupBy(F.expr("__at div 64").alias("__word")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(__at % 64 as int))")).alias("__bits")
    )
    asked = values.withColumn("__at", place(columns)).withColumn("__asked", F.expr("__at div 64"))
    # At most MOST_FILTERED * BITS_PER_VALUE / 64 rows.
    held = asked.join(F.broadcast(words), F.col("__asked") == F.col("__word"))
    return held.where("shiftright(__bits, cast(__at % 64 as int)) & 1 = 1").select(*columns)
