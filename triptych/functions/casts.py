"""Casts that round like the system whose results we match."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Decimals with enough integer digits for any result; the rest is fraction.
_TEXT_NUMBERS = {"int": "decimal(38,27)", "bigint": "decimal(38,18)"}


def _cast(column: Column, target: str, on_error: str) -> Column:
    if on_error == "raise":
        return column.cast(target)
    if on_error == "null":
        return column.try_cast(target)
    raise ValueError(f"on_error must be 'raise' or 'null', not {on_error!r}")


def to_int(
    column: Column, source_type: T.DataType, on_error: str = "raise", target: str = "int"
) -> Column:
    """Cast to int or bigint, rounding fractions where a plain Spark cast would cut them.

    Floating point values round half to even; decimals and numbers in text round
    half away from zero.
    """
    if isinstance(source_type, T.FractionalType) and not isinstance(source_type, T.DecimalType):
        column = F.rint(column)
    elif isinstance(source_type, T.DecimalType):
        column = F.round(column, 0)
    elif isinstance(source_type, T.StringType):
        column = F.round(_cast(column, _TEXT_NUMBERS[target], on_error), 0)
    return _cast(column, target, on_error)


def to_type(
    column: Column, source_type: T.DataType, target: str, on_error: str = "raise"
) -> Column:
    """Cast to ``target``; ``on_error="null"`` turns unreadable values into null."""
    if target in _TEXT_NUMBERS:
        return to_int(column, source_type, on_error, target)
    return _cast(column, target, on_error)
