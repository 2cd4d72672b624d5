"""Rows that share a key."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowtide.errors import DUPLICATE_MARK

KEEP_LAST, REJECT = "last", "reject"

_POSITION = "__position"


def keep_last(
    df: DataFrame, keys: Sequence[str], sequence: str | None = None, sequence_is_distinct: bool = False,
    pass_incomplete: bool = False,
) -> DataFrame:
    """The last row of each key in ``sequence`` order; ties fall to the largest other values.

    Spark drops all but the first-ranked rows before the shuffle, so a key that fills a third of
    the rows sends one row per map task. A sequence known to be distinct needs no tie-break, and
    then only the columns that are asked for are read. With ``pass_incomplete`` a key that holds a null
    equals no other, and its rows all stay.
    """
    if pass_incomplete:
        ranked = keep_last(_complete(df, keys), keys, sequence, sequence_is_distinct)
        return ranked.union(_incomplete(df, keys))
    order = [sequence] if sequence else []
    if not sequence_is_distinct or not order:
        order += [f.name for f in df.schema if f.name not in keys and f.name != sequence and _sortable(f.dataType)]
    descending = [F.col(name).desc_nulls_last() for name in order or keys]
    within_key = Window.partitionBy(*keys).orderBy(*descending)
    ranked = df.withColumn(_POSITION, F.row_number().over(within_key))
    return ranked.where(F.col(_POSITION) == 1).drop(_POSITION)


def keep_single(df: DataFrame, keys: Sequence[str], pass_incomplete: bool = False) -> DataFrame:
    """``df`` itself, as long as no key repeats; a repeated key stops the job that reads it.

    With ``pass_incomplete`` a key that holds a null equals no other.
    """
    if pass_incomplete:
        return keep_single(_complete(df, keys), keys).union(_incomplete(df, keys))
    within_key = Window.partitionBy(*keys).orderBy(keys[0])
    ranked = df.withColumn(_POSITION, F.row_number().over(within_key))
    repeated = F.raise_error(F.concat_ws(" ", F.lit(DUPLICATE_MARK), *(F.col(k).cast("string") for k in keys)))
    first = F.when(F.col(_POSITION) > 1, repeated.cast("boolean")).otherwise(F.lit(True))
    return ranked.where((F.col(_POSITION) <= 2) & first).drop(_POSITION)


def _complete(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.where(reduce(and_, (F.col(k).isNotNull() for k in keys)))


def _incomplete(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.where(reduce(or_, (F.col(k).isNull() for k in keys)))


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Each key that occurs more than once, with its number of rows in ``copies``."""
    counted = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies"))
    return counted.where(F.col("copies") > 1)


def _sortable(data_type: T.DataType) -> bool:
    if isinstance(data_type, T.MapType):
        return False
    if isinstance(data_type, T.ArrayType):
        return _sortable(data_type.elementType)
    if isinstance(data_type, T.StructType):
        return all(_sortable(f.dataType) for f in data_type)
    return not isinstance(data_type, T.VariantType)
