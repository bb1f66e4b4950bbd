"""Additive scores."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F


def additive_score(terms: Sequence[tuple[str, int]]) -> Column:
    """Sum of the points of every condition that holds; null conditions give 0."""
    return reduce(
        add, [F.when(F.expr(condition), points).otherwise(0) for condition, points in terms]
    )
