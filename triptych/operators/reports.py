"""Count reports."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table_counts(
    tables: Mapping[str, DataFrame], name: str = "layer", count: str = "record_count"
) -> DataFrame:
    """One row per table.  On Parquet this reads file footers, no columns."""
    return reduce(
        DataFrame.unionByName,
        [
            table.agg(F.count(F.lit(1)).alias(count)).select(F.lit(label).alias(name), count)
            for label, table in tables.items()
        ],
    )


def known_counts(
    spark: SparkSession, counts: Mapping[str, int], name: str = "layer", count: str = "record_count"
) -> DataFrame:
    """The same rows from counts that are known; reads nothing."""
    rows = [F.struct(F.lit(label).alias(name), F.lit(n).cast("bigint").alias(count)) for label, n in counts.items()]
    if not rows:
        return spark.createDataFrame([], f"{name} string, {count} bigint")
    return spark.range(1, numPartitions=1).select(F.inline(F.array(*rows)))


def quality_stats(validated: DataFrame, flag: str = "has_quality_issues") -> DataFrame:
    """Total, flagged and clean rows in one row; the sums are null without input."""
    issues = F.sum(F.when(F.col(flag), 1).otherwise(0))
    total = F.count(F.lit(1))
    return validated.agg(
        total.alias("total_records"),
        issues.alias("records_with_issues"),
        (total - issues).alias("clean_records"),
    )


def as_metric_rows(
    row: DataFrame, metrics: Mapping[str, str | Column], name: str = "metric", value: str = "value"
) -> DataFrame:
    """Turn the columns of a one-row frame into (label, value) rows."""
    cells = []
    for label, column in metrics.items():
        cells += [F.lit(label), F.col(column) if isinstance(column, str) else column]
    return row.select(F.stack(F.lit(len(metrics)), *cells).alias(name, value))
