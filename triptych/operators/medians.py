"""Exact medians of whole numbers of any range."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

_LEVEL_BITS = 16
_VALUE_BITS = {T.ByteType(): 8, T.ShortType(): 16, T.IntegerType(): 32, T.LongType(): 64}


def join_on_keys(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Equi-join in which null keys match each other; the keys appear once."""
    renamed = right.withColumnsRenamed({key: f"_right_{key}" for key in keys})
    matches = reduce(and_, [left[key].eqNullSafe(renamed[f"_right_{key}"]) for key in keys])
    return left.join(renamed, matches, how).drop(*[f"_right_{key}" for key in keys])


def _levels(df: DataFrame, columns: Sequence[str], ranges: Mapping[str, tuple[int, int]] | None) -> int:
    """Levels of buckets that the widest column needs.

    The type alone says two for int and four for bigint.  The range of the values says
    less in most cases: a known one, or the observed one, from a pass that only takes
    least and largest values.
    """
    by_type = -(-max(_VALUE_BITS[df.schema[column].dataType] for column in columns) // _LEVEL_BITS)
    if by_type == 1:
        return 1
    unknown = [column for column in columns if column not in (ranges or {})]
    widths = [high - low for column, (low, high) in (ranges or {}).items() if column in columns]
    if unknown:
        extremes = [F.struct(F.min(c).cast("bigint"), F.max(c).cast("bigint")) for c in unknown]
        widths += [high - low for low, high in df.agg(*extremes).first() if low is not None]
    bits = max(widths, default=0).bit_length()
    return min(by_type, max(1, -(-bits // _LEVEL_BITS)))


def medians_by_measure(
    df: DataFrame,
    keys: Sequence[str],
    columns: Sequence[str],
    ranges: Mapping[str, tuple[int, int]] | None = None,
) -> DataFrame:
    """keys, ``_measure`` (place in ``columns``) and ``_median`` of tinyint to bigint columns.

    Groups without a value of a measure have no row for it.  ``ranges`` are known least
    and largest values of columns; without them they are observed.  They decide the plan,
    never the result.

    No task ever holds a whole group.  Rows are counted per measure and value,
    combined on the map side, then per bucket of 65,536 neighbouring values, per
    65,536 neighbouring buckets and so on, until a group has at most 65,536 buckets
    at the top.  From there down, the bucket with the middle rows is opened level by
    level.  Every ranking and every join thus sees at most some 65,536 rows of a group,
    however many rows or distinct values it has.  Where all values lie within 65,536 of
    each other, the counts per value are the only level: a dense histogram per group and
    measure, merged in one shuffle.
    """
    kinds = [df.schema[column].dataType for column in columns]
    for column, kind in zip(columns, kinds):
        if kind not in _VALUE_BITS:
            raise ValueError(f"median of {column}: {kind.simpleString()} is no whole-number type")
    levels = _levels(df, columns, ranges)

    # Unlike unpivot, stack leaves plans that Spark finds equal, so the counts are shared.
    cells: list[Column] = []
    for place, column in enumerate(columns):
        cells += [F.lit(place), F.col(column).cast("bigint")]
    values = df.select(
        *keys, F.stack(F.lit(len(columns)), *cells).alias("_measure", "_value")
    ).filter(F.col("_value").isNotNull())
    group = [*keys, "_measure"]
    counts = [values.groupBy(*group, "_value").agg(F.count(F.lit(1)).alias("_rows"))]
    parent = F.shiftright("_value", _LEVEL_BITS)
    for _ in range(levels - 1):
        buckets = counts[-1].groupBy(*group, parent.alias("_value"))
        counts.append(buckets.agg(F.sum("_rows").alias("_rows")))

    def rows_up_to(*within: str) -> Column:
        window = Window.partitionBy(*group, *within).orderBy("_value")
        return F.sum("_rows").over(window.rowsBetween(Window.unboundedPreceding, 0))

    def middle(ranked: DataFrame) -> DataFrame:
        """Of a level's rows those with the middle rows; _start counts the rows before."""
        return (
            ranked.withColumn("_start", F.col("_end") - F.col("_rows"))
            .filter("_start <= _upper AND _end > _lower")
            .select(*group, "_value", "_start", "_lower", "_upper")
        )

    # Positions count from 0; _lower and _upper are those of the middle rows.
    total = F.sum("_rows").over(Window.partitionBy(*group))
    chosen = middle(
        counts.pop()
        .withColumns({"_end": rows_up_to(), "_total": total})
        .withColumns({"_lower": F.expr("(_total - 1) div 2"), "_upper": F.expr("_total div 2")})
    )
    while counts:
        opened = join_on_keys(
            counts.pop().withColumn("_parent", parent),
            chosen.withColumnRenamed("_value", "_parent"),
            [*group, "_parent"],
            "inner",
        )
        chosen = middle(opened.withColumn("_end", F.col("_start") + rows_up_to("_parent")))
    return chosen.groupBy(*group).agg(F.avg("_value").alias("_median"))


def exact_medians(df: DataFrame, keys: Sequence[str], column: str, name: str) -> DataFrame:
    """Median of one whole-number column per group; groups without a value are left out."""
    return medians_by_measure(df, keys, [column]).select(*keys, F.col("_median").alias(name))
