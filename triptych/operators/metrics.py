"""Averages, extremes and exact medians of several measures."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from triptych.operators.medians import medians_by_measure


def measure_metrics(
    df: DataFrame,
    keys: Sequence[str],
    measures: Mapping[str, str],
    *,
    count: str = "n",
    averages: Mapping[str, str] | None = None,
    maxima: Mapping[str, str] | None = None,
    conditional_counts: Mapping[str, str | Column] | None = None,
    ranges: Mapping[str, tuple[int, int]] | None = None,
) -> DataFrame:
    """Per group: rows, then ``avg_x, min_x, max_x, median_x`` of each measure.

    ``measures`` maps the suffix ``x`` to a column of a whole-number type, tinyint to
    bigint; several suffixes may name the same column.  ``averages``, ``maxima`` and
    ``conditional_counts`` (output name -> column or condition) add aggregates that
    need no median.  Without keys the whole table is one group.  ``ranges`` are known
    least and largest values of measures, which spare the medians a look at the data.

    All but the medians is one ordinary aggregation.  The medians of all measures
    come from one more pass that never gathers a group (see ``medians_by_measure``).
    Both hold a few rows per group, which a last aggregation puts side by side;
    unlike a join it also takes null keys, and no keys, as they are.
    """
    columns = list(dict.fromkeys(measures.values()))
    plain = {count: F.count(F.lit(1))}
    for suffix, column in measures.items():
        plain[f"avg_{suffix}"] = F.avg(column)
        plain[f"min_{suffix}"] = F.min(column)
        plain[f"max_{suffix}"] = F.max(column)
    plain |= {name: F.avg(column) for name, column in (averages or {}).items()}
    plain |= {name: F.max(column) for name, column in (maxima or {}).items()}
    plain |= {name: F.count_if(test) for name, test in (conditional_counts or {}).items()}
    result = df.groupBy(*keys).agg(*[value.alias(name) for name, value in plain.items()])
    if not columns:
        return result

    def median(column: str) -> Column:
        return F.when(F.col("_measure") == columns.index(column), F.col("_median"))

    medians = medians_by_measure(df, keys, columns, ranges).select(
        *keys, *[median(column).alias(f"median_{suffix}") for suffix, column in measures.items()]
    )
    outputs = [count]
    for suffix in measures:
        outputs += [f"{kind}_{suffix}" for kind in ("avg", "min", "max", "median")]
    outputs += [name for name in plain if name not in outputs]
    both = result.unionByName(medians, allowMissingColumns=True)
    # One row of each group has the value, the others null.
    return both.groupBy(*keys).agg(*[F.max(name).alias(name) for name in outputs])
