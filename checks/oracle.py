"""DuckDB SQL that must give the same rows as each registered query.

The rule tables come from the configuration (tests check those values by hand);
how they are applied is written independently of the Spark code: labels are
looked up in relations, medians and filtered counts use the engine's own
functions.
"""

from __future__ import annotations

from checks.catalog import LINEITEM_RULES, SOURCE_TABLES
from checks.fixture import PATIENT_SQL
from triptych import config

_SQL_TYPES = {"int": "INTEGER", "string": "VARCHAR", "boolean": "BOOLEAN", "double": "DOUBLE"}


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _cast_list(source: str = "{0}") -> str:
    return ", ".join(
        f"CAST({source.format(column)} AS {_SQL_TYPES[kind]}) AS {name}"
        for column, name, kind in config.SILVER_COLUMNS
    )


def _parts_relation() -> str:
    rows = [
        f"({_text(field)}, {place}, {_text(part)}, {_text(label)})"
        for field, rules in config.LABEL_PARTS.items()
        for place, (label, parts) in enumerate(rules)
        for part in parts
    ]
    return "VALUES " + ", ".join(rows)


def _alias_relation() -> str:
    rows = [
        f"({_text(alias)}, {_text(label)})"
        for label, aliases in config.SEX_ALIASES
        for alias in aliases
    ]
    return "VALUES " + ", ".join(rows)


def _part_label(field: str) -> str:
    return (
        f"coalesce((SELECT arg_min(p.label, p.place) FROM parts p WHERE p.field = {_text(field)}"
        f" AND contains(lower(typed.{field}), p.part)), 'Unknown') AS {field}"
    )


def _breaks_any(rules) -> str:
    return " OR ".join(
        f"coalesce({r.column} NOT BETWEEN {r.low} AND {r.high}, FALSE)" for r in rules
    )


_SCORE = " + ".join(
    f"{points} * CAST(coalesce({condition}, FALSE) AS INTEGER)"
    for condition, points in config.RISK_SCORE_TERMS
)

_LAYERS = f"""
WITH source AS ({PATIENT_SQL}),
bronze AS (SELECT *, 'orders' AS source_file FROM source),
parts(field, place, part, label) AS ({_parts_relation()}),
sex_alias(alias, label) AS ({_alias_relation()}),
typed AS (SELECT {_cast_list()}, source_file FROM bronze),
standardized AS (
  SELECT typed.* REPLACE (
    coalesce((SELECT a.label FROM sex_alias a WHERE a.alias = lower(trim(typed.sex))), 'Unknown') AS sex,
    trim(dataset) AS dataset,
    {", ".join(_part_label(field) for field in config.LABEL_PARTS)}),
    CASE WHEN heart_disease_severity >= 0 THEN heart_disease_severity <> 0 END AS has_heart_disease
  FROM typed),
validated AS (
  SELECT *,
    {_breaks_any(config.RANGE_RULES)} AS has_quality_issues,
    CASE WHEN age IS NULL THEN 'Unknown' WHEN age >= 70 THEN '70+' WHEN age < 40 THEN '< 40'
         ELSE printf('%d-%d', age // 10 * 10, age // 10 * 10 + 9) END AS age_group,
    CASE WHEN coalesce(max_heart_rate, 0) < 140 THEN 'Low' WHEN max_heart_rate < 160 THEN 'Moderate'
         WHEN max_heart_rate < 180 THEN 'High' ELSE 'Very High' END AS max_heart_rate_category
  FROM standardized),
clean AS (SELECT * FROM validated WHERE NOT has_quality_issues),
demographics AS (
  SELECT sex, age_group, count(*) AS patient_count, avg(age) AS avg_age,
    count(*) FILTER (has_heart_disease) AS heart_disease_count,
    round(heart_disease_count * 100.0 / patient_count, 2) AS heart_disease_percentage,
    avg(resting_blood_pressure) AS avg_blood_pressure,
    avg(cholesterol) AS avg_cholesterol, avg(max_heart_rate) AS avg_max_heart_rate
  FROM clean GROUP BY ALL),
risk AS (
  SELECT chest_pain_type, resting_ecg, exercise_induced_angina, st_slope, thalassemia,
    count(*) AS patient_count, count(*) FILTER (has_heart_disease) AS heart_disease_count,
    round(heart_disease_count * 100.0 / patient_count, 2) AS risk_percentage
  FROM clean GROUP BY ALL),
severity_name(level, label) AS (VALUES {", ".join(f"({v}, {_text(n)})" for v, n in config.SEVERITY_LABELS)}),
severity AS (
  SELECT heart_disease_severity, any_value(label) AS severity_label, count(*) AS patient_count,
    round(patient_count * 100.0 / (SELECT count(*) FROM clean), 2) AS percentage,
    avg(age) AS avg_age, avg(cholesterol) AS avg_cholesterol,
    avg(resting_blood_pressure) AS avg_blood_pressure
  FROM clean LEFT JOIN severity_name ON level = heart_disease_severity
  GROUP BY heart_disease_severity),
clinical AS (
  SELECT dataset, sex, count(*) AS total_patients,
    avg(resting_blood_pressure) AS avg_resting_bp, min(resting_blood_pressure) AS min_resting_bp,
    max(resting_blood_pressure) AS max_resting_bp, median(resting_blood_pressure) AS median_resting_bp,
    avg(cholesterol) AS avg_cholesterol, min(cholesterol) AS min_cholesterol,
    max(cholesterol) AS max_cholesterol, median(cholesterol) AS median_cholesterol,
    avg(max_heart_rate) AS avg_max_heart_rate, min(max_heart_rate) AS min_max_heart_rate,
    max(max_heart_rate) AS max_max_heart_rate, median(max_heart_rate) AS median_max_heart_rate,
    avg(st_depression) AS avg_st_depression, max(st_depression) AS max_st_depression,
    count(*) FILTER (fasting_blood_sugar_high) AS high_fasting_sugar_count,
    count(*) FILTER (exercise_induced_angina) AS exercise_angina_count
  FROM clean GROUP BY ALL),
fact AS (
  SELECT patient_id, age, sex, age_group, dataset, chest_pain_type, resting_blood_pressure,
    cholesterol, fasting_blood_sugar_high, resting_ecg, max_heart_rate, max_heart_rate_category,
    exercise_induced_angina, st_depression, st_slope, num_major_vessels, thalassemia,
    heart_disease_severity, has_heart_disease, {_SCORE} AS calculated_risk_score
  FROM clean)
"""

_RECORD_COUNTS = " UNION ALL ".join(
    f"SELECT {_text(table)} AS layer, count(*) AS record_count FROM {relation}"
    for table, relation in {
        config.BRONZE_TABLE: "bronze",
        config.SILVER_TABLE: "clean",
        config.DEMOGRAPHICS_TABLE: "demographics",
        config.RISK_FACTORS_TABLE: "risk",
        config.SEVERITY_TABLE: "severity",
        config.CLINICAL_TABLE: "clinical",
        config.FACT_TABLE: "fact",
    }.items()
)

_QUALITY_STATS = """
SELECT count(*) AS total_records,
  CAST(sum(CAST(has_quality_issues AS INTEGER)) AS BIGINT) AS records_with_issues,
  CAST(sum(CAST(NOT has_quality_issues AS INTEGER)) AS BIGINT) AS clean_records
FROM """

# Lines 0 modulo 7 have a field too many, others 1 modulo 11 two too few.
_REJECTS = """
SELECT id, line, lost, count(line) OVER () AS malformed_lines,
  CAST(sum(bad_age + bad_ca) OVER () AS BIGINT) AS lost_values
FROM (
  SELECT id, bad_age, bad_ca,
    CASE WHEN id % 7 = 0 THEN concat_ws(',', fields, ca, thal, num, 'surplus')
      WHEN id % 11 = 1 THEN concat_ws(',', fields, ca) END AS line,
    concat_ws(';', CASE bad_age WHEN 1 THEN 'age=old' END, CASE bad_ca WHEN 1 THEN 'ca=n/a' END) AS lost
  FROM (
    SELECT id, CAST(id % 5 = 2 AS INTEGER) AS bad_age, CAST(id % 13 = 3 AS INTEGER) AS bad_ca,
      concat_ws(',', CAST(id AS VARCHAR), CASE WHEN id % 5 = 2 THEN 'old' ELSE coalesce(CAST(age AS VARCHAR), '') END,
        {middle}) AS fields,
      CASE WHEN id % 13 = 3 THEN 'n/a' ELSE coalesce(CAST(ca AS VARCHAR), '') END AS ca,
      coalesce(thal, '') AS thal, coalesce(CAST(num AS VARCHAR), '') AS num
    FROM source
  )
)
WHERE line IS NOT NULL OR lost <> ''
""".format(
    middle=", ".join(f"coalesce(CAST({name} AS VARCHAR), '')" for name in config.SOURCE_SCHEMA.names[2:13])
)

# Queries over the layers above; each string follows the WITH clause.
_LAYER_QUERIES = {
    "bronze_ingest": "SELECT * FROM bronze",
    "bronze_stats": 'SELECT count(*) AS "Total_Records", count(DISTINCT id) AS "Unique_Patients"'
    " FROM bronze",
    "bronze_preview": "SELECT * FROM bronze ORDER BY id LIMIT 5",
    "silver_typed": "SELECT * FROM typed",
    "silver_typed_text": f"SELECT {_cast_list('CAST({0} AS VARCHAR)')}, source_file FROM bronze",
    "silver_standardized": "SELECT * FROM standardized",
    "silver_validated": "SELECT * FROM validated",
    "silver_clean": "SELECT * FROM clean",
    "silver_preview": "SELECT sex, chest_pain_type, resting_ecg, thalassemia, has_heart_disease"
    " FROM standardized ORDER BY patient_id LIMIT 5",
    "stage_counts": " UNION ALL ".join(
        f"SELECT {_text(stage)} AS stage, count(*) AS record_count FROM {stage}"
        for stage in ("typed", "standardized", "validated", "clean")
    ),
    "quality_stats": _QUALITY_STATS + "validated",
    "quality_report": """
        SELECT 'Total Records' AS metric, count(*) AS value FROM bronze
        UNION ALL SELECT 'Records with Quality Issues', count(*) FROM validated
          WHERE has_quality_issues
        UNION ALL SELECT 'Clean Records in Silver', count(*) FROM clean
        UNION ALL SELECT 'Null Values in Critical Fields',
          count(*) FILTER (age IS NULL OR sex IS NULL OR trestbps IS NULL OR chol IS NULL)
          FROM bronze""",
    "age_group_distribution": 'SELECT age_group, count(*) AS "count" FROM clean GROUP BY age_group',
    "sql_views": "SELECT sex, has_quality_issues, count(*) AS n, max(max_heart_rate) AS top_rate"
    " FROM validated GROUP BY ALL",
    "gold_demographics": "SELECT * FROM demographics",
    "gold_risk_factors": "SELECT * FROM risk",
    "gold_severity": "SELECT * FROM severity",
    "gold_clinical_metrics": "SELECT * FROM clinical",
    "gold_fact": "SELECT * FROM fact",
    "record_counts": _RECORD_COUNTS,
    "view_demographics": """
        SELECT sex, age_group, patient_count, heart_disease_percentage,
          round(avg_cholesterol, 1) AS avg_cholesterol, round(avg_blood_pressure, 1) AS avg_bp
        FROM demographics ORDER BY sex, age_group LIMIT 10""",
    "view_top_risk": """
        SELECT chest_pain_type, exercise_induced_angina, patient_count, heart_disease_count,
          risk_percentage
        FROM risk WHERE patient_count >= 10
        ORDER BY risk_percentage DESC, patient_count DESC, chest_pain_type, resting_ecg,
          exercise_induced_angina NULLS LAST, st_slope, thalassemia
        LIMIT 10""",
    "view_severity": "SELECT severity_label, patient_count, percentage,"
    " round(avg_age, 1) AS avg_age FROM severity",
    "parquet_roundtrip": "SELECT * FROM fact",
    "stored_bronze": "SELECT * FROM bronze",
    "stored_demographics": "SELECT * FROM demographics",
    "stored_risk_factors": "SELECT * FROM risk",
    "stored_severity": "SELECT * FROM severity",
    "stored_clinical": "SELECT * FROM clinical",
    # Bronze has one clock, silver two, each gold table one.
    "audit_clocks": "SELECT CAST(sum(n) AS BIGINT) AS clock_values, TRUE AS all_set,"
    " TRUE AS one_value_a_table, TRUE AS ingested_first, TRUE AS created_last FROM ("
    + " UNION ALL ".join(
        f"SELECT count(*) * {clocks} AS n FROM {relation}"
        for relation, clocks in {
            "bronze": 1, "clean": 2, "demographics": 1, "risk": 1, "severity": 1, "clinical": 1, "fact": 1
        }.items()
    )
    + ")",
    "csv_loose_values": "SELECT * FROM source",
    "csv_roundtrip": "SELECT * FROM source",
    "csv_export": "SELECT * FROM fact",
    "csv_rejects": _REJECTS,
    "full_run": _RECORD_COUNTS,
    "full_run_unsaved": _RECORD_COUNTS,
    "catalog_tables": f"SELECT *, 1 AS times_written FROM ({_RECORD_COUNTS})",
}

_TABLE_QUERIES = {
    "orders_standardized": """
        SELECT o_orderkey, CASE substr(o_orderpriority, 1, 1)
          WHEN '1' THEN 'Rush' WHEN '2' THEN 'Rush' WHEN '3' THEN 'Normal' WHEN '5' THEN 'Slow'
          ELSE 'Unknown' END AS priority
        FROM orders""",
    "lineitem_quality": _QUALITY_STATS
    + f"(SELECT {_breaks_any(LINEITEM_RULES)} AS has_quality_issues FROM lineitem)",
    "orders_bucketed": """
        SELECT 'small' AS size, count(*) AS n FROM orders WHERE o_totalprice < 50000
        UNION ALL SELECT 'medium', count(*) FROM orders
          WHERE o_totalprice >= 50000 AND o_totalprice < 150000
        UNION ALL SELECT 'large', count(*) FROM orders
          WHERE o_totalprice >= 150000 AND o_totalprice < 300000
        UNION ALL SELECT 'huge', count(*) FROM orders WHERE o_totalprice >= 300000""",
    "events_share": """
        SELECT event_type, count(*) AS n,
          round(count(*) * 100.0 / sum(count(*)) OVER (), 2) AS percentage
        FROM events GROUP BY event_type""",
    "lineitem_metrics": """
        WITH whole AS (
          SELECT l_returnflag, l_linestatus, CAST(l_quantity AS INTEGER) AS q,
            CAST(l_discount * 100 AS INTEGER) AS d, l_tax FROM lineitem)
        SELECT l_returnflag, l_linestatus, count(*) AS n,
          avg(q) AS avg_quantity, min(q) AS min_quantity, max(q) AS max_quantity,
          median(q) AS median_quantity,
          avg(d) AS avg_discount, min(d) AS min_discount, max(d) AS max_discount,
          median(d) AS median_discount, avg(q) AS mean_quantity, max(d) AS top_discount,
          count(*) FILTER (l_tax > 0.04) AS high_tax_count
        FROM whole GROUP BY l_returnflag, l_linestatus""",
    "orders_price_metrics": """
        WITH priced AS (
          SELECT o_orderpriority, CAST(o_totalprice * 100 AS INTEGER) AS cents FROM orders)
        SELECT o_orderpriority, count(*) AS n, avg(cents) AS avg_cents, min(cents) AS min_cents,
          max(cents) AS max_cents, median(cents) AS median_cents
        FROM priced GROUP BY o_orderpriority""",
    "lineitem_price_metrics": """
        WITH priced AS (
          SELECT l_returnflag, l_linestatus, CAST(l_extendedprice * 100 AS BIGINT) AS cents
          FROM lineitem)
        SELECT l_returnflag, l_linestatus, count(*) AS n, avg(cents) AS avg_cents,
          min(cents) AS min_cents, max(cents) AS max_cents, median(cents) AS median_cents
        FROM priced GROUP BY l_returnflag, l_linestatus""",
    "customer_score": """
        SELECT c_custkey,
          (CASE WHEN c_acctbal > 5000 THEN 2 WHEN c_acctbal < 0 THEN 1 ELSE 0 END)
          + (CASE WHEN c_mktsegment = 'BUILDING' THEN 3 ELSE 0 END)
          + (CASE WHEN c_nationkey >= 12 THEN 1 ELSE 0 END) AS score
        FROM customer""",
    "source_table_counts": " UNION ALL ".join(
        f"SELECT {_text(name)} AS layer, count(*) AS record_count FROM {name}"
        for name in SOURCE_TABLES
    ),
}

ORACLE_SQL = {
    **{name: _LAYERS + sql for name, sql in _LAYER_QUERIES.items()},
    **_TABLE_QUERIES,
}
