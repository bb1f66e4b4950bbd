"""Patient-shaped rows computed from the ``orders`` table.

The expressions run unchanged in Spark and in DuckDB, so both sides of a check
start from the same rows.  The remainders spread every label, null and
out-of-range value over the rows; none of them drops a row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

# Column name and expression, see FIXTURES.md.
PATIENT_COLUMNS = {
    "id": "o_orderkey",
    "age": "CASE WHEN (o_orderkey*7919)%1009%41 = 0 THEN NULL"
    " ELSE 15 + (o_orderkey*31)%1013%89 END",
    "sex": "CASE (o_orderkey*6007)%1019%8 WHEN 0 THEN 'Male' WHEN 1 THEN ' m ' WHEN 2 THEN '1'"
    " WHEN 3 THEN 'FEMALE' WHEN 4 THEN 'f' WHEN 5 THEN '0' WHEN 6 THEN 'other' ELSE NULL END",
    "dataset": "CASE (o_orderkey*5003)%1021%5 WHEN 0 THEN ' SiteA ' WHEN 1 THEN 'SiteA'"
    " WHEN 2 THEN 'SiteB' WHEN 3 THEN 'SiteC' ELSE NULL END",
    "cp": "CASE (o_orderkey*4001)%1031%6 WHEN 0 THEN 'typical angina' WHEN 1 THEN"
    " 'Atypical Angina' WHEN 2 THEN 'non-anginal' WHEN 3 THEN 'asymptomatic'"
    " WHEN 4 THEN 'other' ELSE NULL END",
    "trestbps": "CASE WHEN (o_orderkey*3001)%1033%37 = 0 THEN NULL"
    " ELSE 75 + ((o_orderkey*37)%1039%356) * CAST(0.5 AS DOUBLE) END",
    "chol": "CASE WHEN (o_orderkey*2003)%1049%29 = 0 THEN NULL"
    " ELSE 95 + (o_orderkey*53)%1051%511 END",
    "fbs": "CASE WHEN (o_orderkey*1009)%1061%6 = 0 THEN NULL"
    " WHEN (o_orderkey*1009)%1061%6 < 3 THEN TRUE ELSE FALSE END",
    "restecg": "CASE (o_orderkey*2017)%1063%5 WHEN 0 THEN 'normal' WHEN 1 THEN 'lv hypertrophy'"
    " WHEN 2 THEN 'st-t abnormality' WHEN 3 THEN 'inverted wave' ELSE NULL END",
    "thalch": "CASE WHEN (o_orderkey*3011)%1069%31 = 0 THEN NULL"
    " ELSE 57 + (o_orderkey*61)%1087%167 END",
    "exang": "CASE WHEN (o_orderkey*4013)%1091%6 = 0 THEN NULL"
    " WHEN (o_orderkey*4013)%1091%6 < 3 THEN TRUE ELSE FALSE END",
    "oldpeak": "CASE WHEN (o_orderkey*5009)%1093%43 = 0 THEN NULL"
    " ELSE ((o_orderkey*17)%1097%85 - 2) * CAST(0.125 AS DOUBLE) END",
    "slope": "CASE (o_orderkey*6011)%1103%5 WHEN 0 THEN 'upsloping' WHEN 1 THEN 'FLAT'"
    " WHEN 2 THEN 'downsloping' WHEN 3 THEN '?' ELSE NULL END",
    "ca": "CASE WHEN (o_orderkey*7001)%1109%5 = 4 THEN NULL ELSE (o_orderkey*7001)%1109%5 END",
    "thal": "CASE (o_orderkey*8009)%1117%4 WHEN 0 THEN 'normal' WHEN 1 THEN 'fixed defect'"
    " WHEN 2 THEN 'reversable defect' ELSE NULL END",
    "num": "CASE WHEN (o_orderkey*9001)%1123%6 = 5 THEN NULL ELSE (o_orderkey*9001)%1123%6 END",
}

PATIENT_SQL = (
    "SELECT " + ", ".join(f"{sql} AS {name}" for name, sql in PATIENT_COLUMNS.items())
    + " FROM orders"
)


def patients(orders: DataFrame) -> DataFrame:
    """The same rows from an ``orders`` DataFrame."""
    return orders.selectExpr(*[f"{sql} AS {name}" for name, sql in PATIENT_COLUMNS.items()])
