"""Silver: typed, standardized and validated rows.

All three stages are projections without a shuffle; Spark collapses them, so the
whole layer is one pass over bronze.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from triptych import config
from triptych.config import RangeRule
from triptych.functions import (
    any_null,
    breaks_any,
    bucketize,
    label_by_alias,
    label_by_part,
    positive_flag,
    to_type,
)

# Edges and labels, as bucketize takes them.
Buckets = tuple[Sequence[float], Sequence[str]]


def typed(
    bronze: DataFrame,
    columns: Sequence[tuple[str, str, str]] = config.SILVER_COLUMNS,
    keep: Sequence[str] = config.AUDIT_COLUMNS,
    on_error: str = "raise",
) -> DataFrame:
    """Cast and rename; ``keep`` columns pass through unchanged."""
    types = {field.name.lower(): field.dataType for field in bronze.schema.fields}
    return bronze.select(
        *[
            to_type(F.col(source), types[source.lower()], target, on_error).alias(name)
            for source, name, target in columns
        ],
        *keep,
    )


def lost_casts(
    bronze: DataFrame, columns: Sequence[tuple[str, str, str]] = config.SILVER_COLUMNS
) -> Column:
    """How many values the lenient casts of ``typed`` turn into null, as an aggregate."""
    types = {field.name.lower(): field.dataType for field in bronze.schema.fields}
    lost = [
        (F.col(source).isNotNull() & to_type(F.col(source), types[source.lower()], target, "null").isNull()).cast("int")
        for source, _, target in columns
    ]
    return F.coalesce(F.sum(reduce(add, lost)), F.lit(0)).cast("bigint")


def standardized(
    df: DataFrame,
    sex_aliases: Sequence[tuple[str, Sequence[str]]] = config.SEX_ALIASES,
    label_parts: dict[str, Sequence[tuple[str, Sequence[str]]]] = config.LABEL_PARTS,
    default: str = config.UNKNOWN,
) -> DataFrame:
    """Replace free text by labels and derive the disease flag."""
    labelled = df.withColumns(
        {
            "sex": label_by_alias(F.col("sex"), sex_aliases, default),
            "dataset": F.trim("dataset"),
            **{
                name: label_by_part(F.col(name), rules, default)
                for name, rules in label_parts.items()
            },
            "has_heart_disease": positive_flag(F.col("heart_disease_severity")),
        }
    )
    order = list(df.columns)
    order.insert(order.index("heart_disease_severity") + 1, "has_heart_disease")
    return labelled.select(*order)


def validated(
    df: DataFrame,
    rules: Sequence[RangeRule] = config.RANGE_RULES,
    age_buckets: Buckets = (config.AGE_EDGES, config.AGE_GROUPS),
    heart_rate_buckets: Buckets = (config.HEART_RATE_EDGES, config.HEART_RATE_CATEGORIES),
) -> DataFrame:
    """Flag rows out of range and bucket age and heart rate.

    A null age is unknown; a null heart rate counts as the lowest category.
    """
    lowest_rate = heart_rate_buckets[1][0]
    return df.withColumns(
        {
            "has_quality_issues": breaks_any(rules),
            "age_group": bucketize(F.col("age"), *age_buckets, config.UNKNOWN),
            "max_heart_rate_category": bucketize(
                F.col("max_heart_rate"), *heart_rate_buckets, lowest_rate
            ),
            "validation_timestamp": F.current_timestamp(),
        }
    )


def clean(df: DataFrame) -> DataFrame:
    """Rows that break no rule.  Their flag is false, so it is not computed again."""
    return df.filter(~F.col("has_quality_issues")).withColumn("has_quality_issues", F.lit(False))


def checked(
    bronze: DataFrame,
    rules: Sequence[RangeRule] = config.RANGE_RULES,
    critical: Sequence[str] = config.CRITICAL_SOURCE_COLUMNS,
    columns: Sequence[tuple[str, str, str]] = config.SILVER_COLUMNS,
    on_error: str = "raise",
) -> DataFrame:
    """Validated rows that also say whether a critical source value was null."""
    flagged = bronze.withColumn("has_null_critical", any_null(critical))
    return (
        flagged.transform(
            typed, columns, keep=(*config.AUDIT_COLUMNS, "has_null_critical"), on_error=on_error
        )
        .transform(standardized)
        .transform(validated, rules=rules)
    )


def quality_metrics() -> list[Column]:
    """The four report numbers as aggregates over ``checked`` rows."""
    return [
        F.count(F.lit(1)).alias("total_records"),
        F.count_if("has_quality_issues").alias("records_with_issues"),
        F.count_if(~F.col("has_quality_issues")).alias("clean_records"),
        F.count_if("has_null_critical").alias("null_critical_records"),
    ]
