"""Default rules and names.

Every function in the package takes its rules as arguments; the values here are
only the defaults.  All of them are fixed values: results are compared with an
existing system, so they must not change.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T


@dataclass(frozen=True)
class RangeRule:
    """A column is valid when ``low <= column <= high``; null is valid too."""

    column: str
    low: float
    high: float

    def __post_init__(self) -> None:
        for bound in (self.low, self.high):
            if isinstance(bound, bool) or not isinstance(bound, (int, float)):
                raise ValueError(f"bound of {self.column} is not a number: {bound!r}")
        if self.low > self.high:
            raise ValueError(f"empty range for {self.column}: {self.low}..{self.high}")


# --- fixed values: source file -------------------------------------------------

SOURCE_SCHEMA = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("age", T.LongType()),
        T.StructField("sex", T.StringType()),
        T.StructField("dataset", T.StringType()),
        T.StructField("cp", T.StringType()),
        T.StructField("trestbps", T.DoubleType()),
        T.StructField("chol", T.LongType()),
        T.StructField("fbs", T.BooleanType()),
        T.StructField("restecg", T.StringType()),
        T.StructField("thalch", T.LongType()),
        T.StructField("exang", T.BooleanType()),
        T.StructField("oldpeak", T.DoubleType()),
        T.StructField("slope", T.StringType()),
        T.StructField("ca", T.LongType()),
        T.StructField("thal", T.StringType()),
        T.StructField("num", T.LongType()),
    ]
)

AUDIT_COLUMNS = ("ingestion_timestamp", "source_file")

# --- fixed values: silver columns (source name, silver name, silver type) ------

SILVER_COLUMNS = (
    ("id", "patient_id", "int"),
    ("age", "age", "int"),
    ("sex", "sex", "string"),
    ("dataset", "dataset", "string"),
    ("cp", "chest_pain_type", "string"),
    ("trestbps", "resting_blood_pressure", "int"),
    ("chol", "cholesterol", "int"),
    ("fbs", "fasting_blood_sugar_high", "boolean"),
    ("restecg", "resting_ecg", "string"),
    ("thalch", "max_heart_rate", "int"),
    ("exang", "exercise_induced_angina", "boolean"),
    ("oldpeak", "st_depression", "double"),
    ("slope", "st_slope", "string"),
    ("ca", "num_major_vessels", "int"),
    ("thal", "thalassemia", "string"),
    ("num", "heart_disease_severity", "int"),
)

# --- fixed values: labels, in order of precedence -------------------------------

UNKNOWN = "Unknown"

SEX_ALIASES = (
    ("Male", ("male", "m", "1")),
    ("Female", ("female", "f", "0")),
)

# The first matching part wins.  "typical" is also part of "atypical", and
# "normal" of "abnormal": with this order those inputs take the earlier label.
# Pass another order to change that.
LABEL_PARTS = {
    "chest_pain_type": (
        ("Typical Angina", ("typical",)),
        ("Atypical Angina", ("atypical",)),
        ("Non-Anginal Pain", ("non",)),
        ("Asymptomatic", ("asymp",)),
    ),
    "resting_ecg": (
        ("Normal", ("normal",)),
        ("LV Hypertrophy", ("hypertrophy",)),
        ("ST-T Abnormality", ("abnormal", "wave")),
    ),
    "st_slope": (
        ("Upsloping", ("up",)),
        ("Flat", ("flat",)),
        ("Downsloping", ("down",)),
    ),
    "thalassemia": (
        ("Normal", ("normal",)),
        ("Fixed Defect", ("fixed",)),
        ("Reversible Defect", ("revers",)),
    ),
}

SEVERITY_LABELS = (
    (0, "No Disease"),
    (1, "Mild"),
    (2, "Moderate"),
    (3, "Severe"),
    (4, "Very Severe"),
)

# --- fixed values: buckets ------------------------------------------------------

AGE_EDGES = (40, 50, 60, 70)
AGE_GROUPS = ("< 40", "40-49", "50-59", "60-69", "70+")

HEART_RATE_EDGES = (140, 160, 180)
HEART_RATE_CATEGORIES = ("Low", "Moderate", "High", "Very High")

# --- fixed values: quality rules ------------------------------------------------

RANGE_RULES = (
    RangeRule("age", 18, 100),
    RangeRule("resting_blood_pressure", 80, 250),
    RangeRule("cholesterol", 100, 600),
    RangeRule("max_heart_rate", 60, 220),
    RangeRule("st_depression", 0.0, 10.0),
)

CRITICAL_SOURCE_COLUMNS = ("age", "sex", "trestbps", "chol")

# --- fixed values: additive risk score (condition, points) ----------------------

RISK_SCORE_TERMS = (
    ("age > 60", 2),
    ("sex = 'Male'", 1),
    ("chest_pain_type = 'Asymptomatic'", 2),
    ("resting_blood_pressure > 140", 2),
    ("cholesterol > 240", 2),
    ("fasting_blood_sugar_high", 1),
    ("max_heart_rate < 120", 2),
    ("exercise_induced_angina", 2),
    ("st_depression > 2.0", 2),
    ("num_major_vessels >= 2", 2),
)

# --- fixed values: table and folder names ---------------------------------------

BRONZE_TABLE = "bronze_heart_disease"
SILVER_TABLE = "silver_heart_disease"
DEMOGRAPHICS_TABLE = "gold_demographics_summary"
RISK_FACTORS_TABLE = "gold_risk_factors"
SEVERITY_TABLE = "gold_severity_distribution"
CLINICAL_TABLE = "gold_clinical_metrics"
FACT_TABLE = "gold_powerbi_fact_table"

STAGE_VIEWS = (
    "silver_stage1_typed",
    "silver_stage2_standardized",
    "silver_stage3_validated",
)

LAYER_PATHS = {
    BRONZE_TABLE: "Bronze/bronze_layer_heart_data.parquet",
    SILVER_TABLE: "Silver/silver_layer_heart_data.parquet",
    DEMOGRAPHICS_TABLE: "Gold/gold_demographics_summary.parquet",
    RISK_FACTORS_TABLE: "Gold/gold_risk_factors.parquet",
    SEVERITY_TABLE: "Gold/gold_severity_distribution.parquet",
    CLINICAL_TABLE: "Gold/gold_clinical_metrics.parquet",
    FACT_TABLE: "Gold/gold_powerbi_fact_table.parquet",
}

# --- tables of its own ----------------------------------------------------------

#: Lines and values that lenient reading could not keep; not a layer table.
REJECTS_TABLE = "bronze_rejects"
REJECTS_PATH = "Bronze/bronze_rejects.parquet"
