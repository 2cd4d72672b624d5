"""The source as an operation reads it: renamed, pruned, cast and checked."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowtide.errors import CONSTRAINT_MARK, ConfigurationError
from rowtide.functions.enums import enum_code
from rowtide.plans.roles import ORDINAL
from rowtide.spec import TableSpec

SENT = "__sent_"
SEQUENCE = "__sequence"
FOLDED = "__folded_"
HIT = "__hit"


def sent(name: str) -> str:
    """The staged name of a column, apart from the target's column of that name."""
    return SENT + name


def renamed(source: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """``source`` with its columns called what the target calls them."""
    unknown = [name for name in mapping if name not in source.columns]
    if unknown:
        raise ConfigurationError(f"column mapping names unknown source column {', '.join(unknown)}")
    result = source.withColumnsRenamed(dict(mapping)) if mapping else source
    if len(set(result.columns)) < len(result.columns):
        raise ConfigurationError("column mapping gives two source columns one name")
    return result


def stage(
    source: DataFrame,
    spec: TableSpec,
    target_schema: T.StructType,
    columns: Sequence[str],
    match: Sequence[str],
    checked: Sequence[str],
    ordinal: str | None,
    sequence: str | None,
    null_keys: str,
    nulls_take_defaults: bool = False,
    folded: Iterable[str] = (),
    collation: str | None = None,
) -> DataFrame:
    """The columns an operation reads, under their staged names.

    ``checked`` are the columns whose values reach the table. The rules run inside the plan, so
    they cost no pass of their own, and a job that meets a violation commits no file.
    """
    values = []
    given = source.schema
    for name in columns:
        value = F.col(name)
        if _is_label(name, given, target_schema, spec):
            value = enum_code(value, spec.enums[name])
        if given[name].dataType != target_schema[name].dataType:
            value = value.cast(target_schema[name].dataType)
        if nulls_take_defaults and name in spec.defaults:
            value = F.coalesce(value, default_value(spec, name, target_schema))
        if name in match and null_keys == "reject":
            value = F.coalesce(value, _stop(f"null match key {name}"))
        elif name in checked:
            value = _conforming(value, name, spec)
        values.append(value.alias(sent(name)))
        if name in folded:
            values.append(F.collate(value, collation).alias(sent(FOLDED + name)))
    if ordinal is not None:
        values.append(F.col(ordinal).cast("long").alias(ORDINAL))
    if sequence is not None:
        values.append(F.col(sequence).alias(SEQUENCE))
    return source.select(*values)


def _is_label(name: str, given: T.StructType, target_schema: T.StructType, spec: TableSpec) -> bool:
    """Whether the source holds labels where the table stores enum codes."""
    stored = target_schema[name].dataType
    return name in spec.enums and isinstance(given[name].dataType, T.StringType) and stored != given[name].dataType


def default_value(spec: TableSpec, name: str, target_schema: T.StructType) -> Column:
    """What the table stores in a column that an insert leaves out."""
    data_type = target_schema[name].dataType
    return F.expr(spec.defaults[name]).cast(data_type) if name in spec.defaults else F.lit(None).cast(data_type)


def violation(value: Column, name: str, spec: TableSpec) -> Column | None:
    """A condition that holds for values the column does not take; ``None`` without a rule. Keys are required."""
    conditions = []
    if name in spec.required or name in spec.keys:
        conditions.append(value.isNull())
    if name in spec.max_length:
        conditions.append(F.coalesce(F.length(value) > spec.max_length[name], F.lit(False)))
    if not conditions:
        return None
    return conditions[0] if len(conditions) == 1 else conditions[0] | conditions[1]


def _conforming(value: Column, name: str, spec: TableSpec) -> Column:
    broken = violation(value, name, spec)
    return value if broken is None else F.when(broken, _stop(f"value not allowed in {name}")).otherwise(value)


def _stop(message: str) -> Column:
    return F.raise_error(F.lit(f"{CONSTRAINT_MARK} {message}"))
