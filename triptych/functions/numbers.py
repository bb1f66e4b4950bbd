"""Rounding and percentages on doubles."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_half_away(column: Column, digits: int) -> Column:
    """Scale, round to a whole number, scale back.

    Spark's own ``round`` looks at the decimal text of a double (0.145 -> 0.15);
    scaling first gives 0.14, as the system whose results we match does.
    """
    factor = float(10**digits)
    return F.round(column.cast("double") * F.lit(factor), 0) / F.lit(factor)


def percent_of(part: Column, whole: Column, digits: int = 2) -> Column:
    """``part`` as a rounded percentage of ``whole``, in double arithmetic."""
    return round_half_away(part.cast("double") * F.lit(100.0) / whole, digits)
