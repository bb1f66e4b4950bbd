"""Exact numbers of distinct whole numbers, by bitmaps where these are dense."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_BUCKET = 32_768
_BITMAP_BYTES = _BUCKET // 8
#: What an id may cost in bitmaps; sent as itself it costs about as much.
_BYTES_PER_ID = 16


def are_dense(df: DataFrame, column: str) -> bool:
    """Whether bitmaps over the range of a column are no larger than its values.

    One pass over the column alone; of a stored table it reads the file statistics or
    that column.
    """
    if not isinstance(df.schema[column].dataType, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return False
    low, high, n = df.agg(F.min(column), F.max(column), F.count(column)).first()
    return n > 0 and ((high - low) // _BUCKET + 2) * _BITMAP_BYTES <= max(n, _BUCKET) * _BYTES_PER_ID


def count_with_distinct(
    df: DataFrame,
    column: str,
    distinct: str,
    *,
    rows: str = "n",
    minima: Mapping[str, str] | None = None,
    dense: bool | None = None,
) -> DataFrame:
    """One row: ``rows``, the ``distinct`` values of ``column`` (nulls left out) and ``minima``.

    Dense whole numbers are marked in bitmaps of 32,768 neighbours, which tasks build,
    send and merge instead of the values: 4 KB for each bucket that a task meets.  Where
    bitmaps would outweigh the values (by ``are_dense``, unless the caller knows), and
    for other types, the values themselves are shuffled.  Both ways are exact.
    """
    minima = minima or {}
    if not (are_dense(df, column) if dense is None else dense):
        lows = [F.min(source).alias(name) for name, source in minima.items()]
        return df.agg(F.count(F.lit(1)).alias(rows), F.count_distinct(column).alias(distinct), *lows)

    def summed(count: Column, name: str) -> Column:
        return F.coalesce(F.sum(count), F.lit(0)).cast("bigint").alias(name)

    marked = df.groupBy(F.bitmap_bucket_number(column).alias("_bucket")).agg(
        F.count(F.lit(1)).alias("_rows"),
        F.bitmap_construct_agg(F.bitmap_bit_position(column)).alias("_bitmap"),
        *[F.min(source).alias(name) for name, source in minima.items()],
    )
    return marked.agg(
        summed(F.col("_rows"), rows),
        summed(F.bitmap_count("_bitmap"), distinct),
        *[F.min(name).alias(name) for name in minima],
    )
