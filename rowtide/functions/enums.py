"""Enum columns: stored as integer codes, shown as labels."""

from __future__ import annotations

from collections.abc import Mapping
from itertools import chain

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowtide.errors import CONSTRAINT_MARK
from rowtide.spec import TableSpec


def enum_code(label: Column, codes: Mapping[str, int]) -> Column:
    """The code of a label. An unknown label stops the job; null stays null."""
    return _looked_up(label, codes).cast("int")


def enum_label(code: Column, codes: Mapping[str, int]) -> Column:
    """The label of a code. An unknown code stops the job; null stays null."""
    return _looked_up(code.cast("int"), {number: text for text, number in codes.items()})


def encode_enums(df: DataFrame, spec: TableSpec) -> DataFrame:
    """``df`` with the labels of the spec's enum columns replaced by their codes."""
    return df.withColumns({n: enum_code(F.col(n), c) for n, c in spec.enums.items() if n in df.columns})


def decode_enums(df: DataFrame, spec: TableSpec) -> DataFrame:
    """``df`` with the codes of the spec's enum columns replaced by their labels."""
    return df.withColumns({n: enum_label(F.col(n), c) for n, c in spec.enums.items() if n in df.columns})


def _looked_up(value: Column, entries: Mapping) -> Column:
    table = F.create_map(*(F.lit(part) for part in chain.from_iterable(entries.items())))
    unknown = F.raise_error(F.concat(F.lit(f"{CONSTRAINT_MARK} unknown enum value "), value.cast("string")))
    return F.when(value.isNotNull(), F.coalesce(F.try_element_at(table, value), unknown))
