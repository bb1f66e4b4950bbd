"""Rule-driven labels.  Rules are tried in order and the first match wins."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F


def _first_match(branches: Iterable[tuple[Column, object]]) -> Column:
    """``F.when`` chain over (condition, value) pairs; null when none holds."""
    (condition, value), *others = branches
    chain = F.when(condition, value)
    for condition, value in others:
        chain = chain.when(condition, value)
    return chain


def label_by_alias(
    column: Column, aliases: Sequence[tuple[str, Sequence[str]]], default: str
) -> Column:
    """Label whose aliases hold the trimmed, lower-case text."""
    text = F.lower(F.trim(column))
    return _first_match((text.isin(*names), label) for label, names in aliases).otherwise(default)


def label_by_part(
    column: Column, rules: Sequence[tuple[str, Sequence[str]]], default: str
) -> Column:
    """Label of the first rule with a part contained in the lower-case text."""
    text = F.lower(column)
    return _first_match(
        (reduce(or_, [text.contains(part) for part in parts]), label) for label, parts in rules
    ).otherwise(default)


def label_by_value(column: Column, labels: Sequence[tuple[object, str]]) -> Column:
    """Label of an exact value; null for any other value."""
    return _first_match((column == F.lit(value), label) for value, label in labels)


def bucketize(
    column: Column, edges: Sequence[float], labels: Sequence[str], missing: str
) -> Column:
    """Label of the half-open bucket ``[edge, next edge)``; ``missing`` for null.

    ``labels`` has one entry more than ``edges``: the first is for values below
    the first edge, the last for values from the last edge on.
    """
    if len(labels) != len(edges) + 1:
        raise ValueError("labels must have one entry more than edges")
    if list(edges) != sorted(edges):
        raise ValueError("edges must ascend")
    below = [(column < F.lit(edge), label) for edge, label in zip(edges, labels)]
    return _first_match([*below, (column.isNotNull(), labels[-1])]).otherwise(missing)


def positive_flag(column: Column) -> Column:
    """False for zero, true above zero, null for null or negative values."""
    return F.when(column >= 0, column > 0)
