"""Share of the total."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from triptych.functions import percent_of


def share_of_total(
    df: DataFrame,
    keys: Sequence[str],
    *,
    count: str = "n",
    share: str = "percentage",
    aggregates: Sequence[Column] = (),
) -> DataFrame:
    """Rows per group and their rounded percentage of all rows.

    The total is a scalar subquery over the grouped rows, not a window, which would move
    every group into one task.  It uses every aggregate, so its grouping is the same plan
    as the groups' own: both share one scan and one shuffle, and what the total reads is
    a row per group.
    """
    rows = F.count(F.lit(1))
    grouped = df.groupBy(*keys).agg(rows.alias(count), *aggregates)
    used = F.bit_xor(F.xxhash64(*grouped.columns)).alias("_used")
    total = grouped.agg(F.struct(F.sum(count).alias("total"), used).alias("t")).scalar()
    return grouped.withColumn(share, percent_of(F.col(count), total.getField("total")))
