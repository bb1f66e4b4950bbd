"""Reports and display views over the layer tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from triptych import config
from triptych.config import RangeRule
from triptych.functions import round_half_away
from triptych.operators import as_metric_rows, ordered, top_rows
from triptych.plans import gold, silver

# Report label and the metric it shows.
QUALITY_METRICS = {
    "Total Records": "total_records",
    "Records with Quality Issues": "records_with_issues",
    "Clean Records in Silver": "clean_records",
    "Null Values in Critical Fields": "null_critical_records",
}


def register_views(tables: Mapping[str, DataFrame]) -> None:
    """Make layer tables, and the silver stages over bronze, available to SQL."""
    for name, table in tables.items():
        table.createOrReplaceTempView(name)
    if config.BRONZE_TABLE in tables:
        typed = silver.typed(tables[config.BRONZE_TABLE])
        standardized = silver.standardized(typed)
        stages = (typed, standardized, silver.validated(standardized))
        for name, stage in zip(config.STAGE_VIEWS, stages):
            stage.createOrReplaceTempView(name)


def quality_report(
    bronze: DataFrame,
    rules: Sequence[RangeRule] = config.RANGE_RULES,
    critical: Sequence[str] = config.CRITICAL_SOURCE_COLUMNS,
) -> DataFrame:
    """(metric, value) rows from one pass over bronze."""
    return as_metric_rows(
        silver.checked(bronze, rules, critical).agg(*silver.quality_metrics()), QUALITY_METRICS
    )


def age_group_distribution(silver_table: DataFrame) -> DataFrame:
    counts = silver_table.groupBy("age_group").agg(F.count(F.lit(1)).alias("count"))
    return ordered(counts, "age_group")


# The columns of silver shown first.
PREVIEW_COLUMNS = ("sex", "chest_pain_type", "resting_ecg", "thalassemia", "has_heart_disease")


def preview(
    df: DataFrame,
    n: int = 5,
    order: Sequence[str] = ("patient_id",),
    columns: Sequence[str] = PREVIEW_COLUMNS,
) -> DataFrame:
    """A few rows, lowest ``order`` keys first; for all columns pass ``["*"]``."""
    return top_rows(df, n, *order).select(*columns)


def bronze_preview(bronze: DataFrame, n: int = 5) -> DataFrame:
    """A few rows as they came, with all columns, lowest ids first."""
    return preview(bronze, n, ["id"], ["*"])


def demographics_view(demographics: DataFrame, n: int = 10) -> DataFrame:
    return top_rows(demographics, n, "sex", "age_group").select(
        "sex",
        "age_group",
        "patient_count",
        "heart_disease_percentage",
        round_half_away(F.col("avg_cholesterol"), 1).alias("avg_cholesterol"),
        round_half_away(F.col("avg_blood_pressure"), 1).alias("avg_bp"),
    )


def top_risk_view(risk_factors: DataFrame, n: int = 10, min_patients: int = 10) -> DataFrame:
    """Groups of enough patients with the highest disease rate.

    Ties are settled by size, then by the group's own columns.
    """
    large = risk_factors.filter(F.col("patient_count") >= min_patients)
    return top_rows(
        large, n, "-risk_percentage", "-patient_count", *gold.RISK_FACTORS
    ).select(
        "chest_pain_type",
        "exercise_induced_angina",
        "patient_count",
        "heart_disease_count",
        "risk_percentage",
    )


def severity_view(severity: DataFrame) -> DataFrame:
    return ordered(severity, "heart_disease_severity").select(
        "severity_label",
        "patient_count",
        "percentage",
        round_half_away(F.col("avg_age"), 1).alias("avg_age"),
    )
