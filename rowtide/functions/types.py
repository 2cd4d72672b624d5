"""Spark types for the value kinds a table column may hold."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import types as T

from rowtide.errors import ConfigurationError

# Value kind -> Spark type. Unsigned kinds take the smallest type that holds their
# whole range; a one-byte unsigned value needs a short.
PLAIN_TYPES = {
    "string": T.StringType(),
    "char": T.StringType(),
    "bytes": T.BinaryType(),
    "guid": T.StringType(),
    "bool": T.BooleanType(),
    "byte": T.ShortType(),
    "sbyte": T.ShortType(),
    "short": T.ShortType(),
    "ushort": T.IntegerType(),
    "int": T.IntegerType(),
    "uint": T.LongType(),
    "long": T.LongType(),
    "ulong": T.DecimalType(20, 0),
    "float": T.FloatType(),
    "double": T.DoubleType(),
    "datetime": T.TimestampNTZType(),
    "datetimeoffset": T.TimestampType(),
    "date": T.DateType(),
    "rowversion": T.LongType(),
    "enum": T.IntegerType(),
}

# The facets a column gets when none are declared.
DEFAULT_PRECISION, DEFAULT_SCALE = 18, 2
LONGEST_DECLARED_LENGTH = 4000


def spark_type(
    kind: str,
    precision: int | None = None,
    scale: int | None = None,
    spark: SparkSession | None = None,
) -> T.DataType:
    """The Spark type of a value kind; ``decimal`` takes precision and scale.

    A time of day is a ``TimeType`` where the session has it switched on, otherwise microseconds
    of the day in a long.
    """
    if kind == "decimal":
        return T.DecimalType(
            DEFAULT_PRECISION if precision is None else precision,
            DEFAULT_SCALE if scale is None else scale,
        )
    if kind == "time":
        return _time_type(spark)
    if kind not in PLAIN_TYPES:
        raise ConfigurationError(f"no Spark type for values of kind '{kind}'")
    return PLAIN_TYPES[kind]


def length_limit(kind: str, length: int | None = None) -> int | None:
    """The longest value a text or binary column takes, or ``None`` for no limit."""
    if kind == "char":
        return length or 1
    if kind not in ("string", "bytes") or length is None:
        return None
    return length if 0 < length <= LONGEST_DECLARED_LENGTH else None


def _time_type(spark: SparkSession | None) -> T.DataType:
    if spark is not None and hasattr(T, "TimeType"):
        if str(spark.conf.get("spark.sql.timeType.enabled", "false")).lower() == "true":
            return T.TimeType(6)
    return T.LongType()
