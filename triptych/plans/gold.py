"""Gold: the tables built from clean silver rows.

None of the builders sorts: stored order is no contract.  ``SORT_KEYS`` is the
order to read each table in.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from triptych import config
from triptych.config import RangeRule
from triptych.functions import additive_score, label_by_value, percent_of
from triptych.operators import measure_metrics, ordered, share_of_total

_ROWS = "patient_count"


def _disease_columns(percentage: str) -> list[Column]:
    """Rows with the disease, and their percentage of the group."""
    diseased = F.count_if("has_heart_disease")
    return [
        diseased.alias("heart_disease_count"),
        percent_of(diseased, F.count(F.lit(1))).alias(percentage),
    ]


def _stamped(df: DataFrame) -> DataFrame:
    return df.withColumn("created_at", F.current_timestamp())


def demographics_summary(silver: DataFrame) -> DataFrame:
    """Patients by sex and age group."""
    return (
        silver.groupBy("sex", "age_group")
        .agg(
            F.count(F.lit(1)).alias(_ROWS),
            F.avg("age").alias("avg_age"),
            *_disease_columns("heart_disease_percentage"),
            F.avg("resting_blood_pressure").alias("avg_blood_pressure"),
            F.avg("cholesterol").alias("avg_cholesterol"),
            F.avg("max_heart_rate").alias("avg_max_heart_rate"),
        )
        .transform(_stamped)
    )


RISK_FACTORS = (
    "chest_pain_type",
    "resting_ecg",
    "exercise_induced_angina",
    "st_slope",
    "thalassemia",
)


def risk_factors(silver: DataFrame, factors: Sequence[str] = RISK_FACTORS) -> DataFrame:
    """Disease rate of every combination of risk factors."""
    return (
        silver.groupBy(*factors)
        .agg(F.count(F.lit(1)).alias(_ROWS), *_disease_columns("risk_percentage"))
        .transform(_stamped)
    )


def severity_distribution(
    silver: DataFrame, labels: Sequence[tuple[int, str]] = config.SEVERITY_LABELS
) -> DataFrame:
    """Patients by severity.  A null severity is a group too, and part of the total."""
    shares = share_of_total(
        silver,
        ["heart_disease_severity"],
        count=_ROWS,
        aggregates=[
            F.avg("age").alias("avg_age"),
            F.avg("cholesterol").alias("avg_cholesterol"),
            F.avg("resting_blood_pressure").alias("avg_blood_pressure"),
        ],
    )
    return shares.select(
        "heart_disease_severity",
        label_by_value(F.col("heart_disease_severity"), labels).alias("severity_label"),
        _ROWS,
        "percentage",
        "avg_age",
        "avg_cholesterol",
        "avg_blood_pressure",
    ).transform(_stamped)


def clinical_metrics(
    silver: DataFrame, rules: Sequence[RangeRule] = config.RANGE_RULES
) -> DataFrame:
    """Spread of the clinical measures by site and sex.

    Clean rows keep the ``rules``, so the ranges of the measures are known.
    """
    return measure_metrics(
        silver,
        ["dataset", "sex"],
        {
            "resting_bp": "resting_blood_pressure",
            "cholesterol": "cholesterol",
            "max_heart_rate": "max_heart_rate",
        },
        count="total_patients",
        averages={"avg_st_depression": "st_depression"},
        maxima={"max_st_depression": "st_depression"},
        conditional_counts={
            "high_fasting_sugar_count": "fasting_blood_sugar_high",
            "exercise_angina_count": "exercise_induced_angina",
        },
        ranges={rule.column: (int(rule.low), int(rule.high)) for rule in rules},
    ).transform(_stamped)


FACT_COLUMNS = (
    "patient_id",
    "age",
    "sex",
    "age_group",
    "dataset",
    "chest_pain_type",
    "resting_blood_pressure",
    "cholesterol",
    "fasting_blood_sugar_high",
    "resting_ecg",
    "max_heart_rate",
    "max_heart_rate_category",
    "exercise_induced_angina",
    "st_depression",
    "st_slope",
    "num_major_vessels",
    "thalassemia",
    "heart_disease_severity",
    "has_heart_disease",
)


def fact_table(
    silver: DataFrame, terms: Sequence[tuple[str, int]] = config.RISK_SCORE_TERMS
) -> DataFrame:
    """One row per patient with an additive risk score; no shuffle."""
    return silver.select(
        *FACT_COLUMNS, additive_score(terms).alias("calculated_risk_score")
    ).transform(_stamped)


BUILDERS: dict[str, Callable[[DataFrame], DataFrame]] = {
    config.DEMOGRAPHICS_TABLE: demographics_summary,
    config.RISK_FACTORS_TABLE: risk_factors,
    config.SEVERITY_TABLE: severity_distribution,
    config.CLINICAL_TABLE: clinical_metrics,
    config.FACT_TABLE: fact_table,
}

SORT_KEYS: dict[str, tuple[str, ...]] = {
    config.DEMOGRAPHICS_TABLE: ("sex", "age_group"),
    config.RISK_FACTORS_TABLE: ("-risk_percentage",),
    config.SEVERITY_TABLE: ("heart_disease_severity",),
    config.CLINICAL_TABLE: ("dataset", "sex"),
}

#: For exports, where every row has a place.
EXPORT_KEYS = {**SORT_KEYS, config.FACT_TABLE: ("patient_id",)}


def in_order(df: DataFrame, table: str) -> DataFrame:
    """A gold table in its reading order; the fact table has none."""
    keys = SORT_KEYS.get(table)
    return ordered(df, *keys) if keys else df
