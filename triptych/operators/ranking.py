"""Ordering with nulls last, and top-k."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _sort_key(key: str) -> Column:
    """``"name"`` ascends, ``"-name"`` descends; nulls come last either way."""
    if key.startswith("-"):
        return F.desc_nulls_last(key[1:])
    return F.asc_nulls_last(key)


def ordered(df: DataFrame, *keys: str) -> DataFrame:
    return df.orderBy(*[_sort_key(key) for key in keys])


def top_rows(df: DataFrame, n: int, *keys: str) -> DataFrame:
    """First ``n`` rows by ``keys``.

    Each task keeps its own best ``n``, so nothing is sorted as a whole.  Give
    enough keys to make the order unique, or ties are cut at random.
    """
    return ordered(df, *keys).limit(n)
