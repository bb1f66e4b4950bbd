"""The fixed values once more, by hand: no change of one of them goes unnoticed."""

from __future__ import annotations

from triptych import config


def test_source_and_silver_columns():
    assert config.SOURCE_SCHEMA.simpleString() == (
        "struct<id:bigint,age:bigint,sex:string,dataset:string,cp:string,trestbps:double,"
        "chol:bigint,fbs:boolean,restecg:string,thalch:bigint,exang:boolean,oldpeak:double,"
        "slope:string,ca:bigint,thal:string,num:bigint>"
    )
    assert [" ".join(column) for column in config.SILVER_COLUMNS] == [
        "id patient_id int",
        "age age int",
        "sex sex string",
        "dataset dataset string",
        "cp chest_pain_type string",
        "trestbps resting_blood_pressure int",
        "chol cholesterol int",
        "fbs fasting_blood_sugar_high boolean",
        "restecg resting_ecg string",
        "thalch max_heart_rate int",
        "exang exercise_induced_angina boolean",
        "oldpeak st_depression double",
        "slope st_slope string",
        "ca num_major_vessels int",
        "thal thalassemia string",
        "num heart_disease_severity int",
    ]
    assert config.AUDIT_COLUMNS == ("ingestion_timestamp", "source_file")
    assert config.CRITICAL_SOURCE_COLUMNS == ("age", "sex", "trestbps", "chol")


def test_labels():
    assert config.UNKNOWN == "Unknown"
    assert dict(config.SEX_ALIASES) == {"Male": ("male", "m", "1"), "Female": ("female", "f", "0")}
    parts = {
        field: [f"{label}: {' '.join(words)}" for label, words in rules]
        for field, rules in config.LABEL_PARTS.items()
    }
    assert parts == {
        "chest_pain_type": [
            "Typical Angina: typical",
            "Atypical Angina: atypical",
            "Non-Anginal Pain: non",
            "Asymptomatic: asymp",
        ],
        "resting_ecg": ["Normal: normal", "LV Hypertrophy: hypertrophy", "ST-T Abnormality: abnormal wave"],
        "st_slope": ["Upsloping: up", "Flat: flat", "Downsloping: down"],
        "thalassemia": ["Normal: normal", "Fixed Defect: fixed", "Reversible Defect: revers"],
    }
    assert [label for _, label in sorted(config.SEVERITY_LABELS)] == [
        "No Disease",
        "Mild",
        "Moderate",
        "Severe",
        "Very Severe",
    ]
    assert [level for level, _ in config.SEVERITY_LABELS] == [0, 1, 2, 3, 4]


def test_buckets_and_rules():
    assert config.AGE_EDGES == (40, 50, 60, 70)
    assert config.AGE_GROUPS == ("< 40", "40-49", "50-59", "60-69", "70+")
    assert config.HEART_RATE_EDGES == (140, 160, 180)
    assert config.HEART_RATE_CATEGORIES == ("Low", "Moderate", "High", "Very High")
    assert {r.column: (r.low, r.high) for r in config.RANGE_RULES} == {
        "age": (18, 100),
        "resting_blood_pressure": (80, 250),
        "cholesterol": (100, 600),
        "max_heart_rate": (60, 220),
        "st_depression": (0.0, 10.0),
    }


def test_score():
    assert dict(config.RISK_SCORE_TERMS) == {
        "age > 60": 2,
        "sex = 'Male'": 1,
        "chest_pain_type = 'Asymptomatic'": 2,
        "resting_blood_pressure > 140": 2,
        "cholesterol > 240": 2,
        "fasting_blood_sugar_high": 1,
        "max_heart_rate < 120": 2,
        "exercise_induced_angina": 2,
        "st_depression > 2.0": 2,
        "num_major_vessels >= 2": 2,
    }


def test_names():
    assert [f"{table} {path}" for table, path in config.LAYER_PATHS.items()] == [
        "bronze_heart_disease Bronze/bronze_layer_heart_data.parquet",
        "silver_heart_disease Silver/silver_layer_heart_data.parquet",
        "gold_demographics_summary Gold/gold_demographics_summary.parquet",
        "gold_risk_factors Gold/gold_risk_factors.parquet",
        "gold_severity_distribution Gold/gold_severity_distribution.parquet",
        "gold_clinical_metrics Gold/gold_clinical_metrics.parquet",
        "gold_powerbi_fact_table Gold/gold_powerbi_fact_table.parquet",
    ]
    assert config.STAGE_VIEWS == (
        "silver_stage1_typed",
        "silver_stage2_standardized",
        "silver_stage3_validated",
    )
