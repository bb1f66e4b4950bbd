from __future__ import annotations

import random
import statistics
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from triptych.operators import exact_medians, measure_metrics, share_of_total, top_rows
from triptych.plans import gold, silver, views


@pytest.fixture(scope="module")
def clean(bronze_rows):
    return silver.clean(silver.validated(silver.standardized(silver.typed(bronze_rows))))


def stage(make_bronze, *rows):
    return silver.validated(silver.standardized(silver.typed(make_bronze(*rows))))


def test_demographics_by_hand(make_bronze):
    rows = stage(
        make_bronze,
        {"sex": "m", "age": 41, "num": 1, "trestbps": 120.0, "chol": 200, "thalch": 150},
        {"sex": "m", "age": 44, "num": 0, "trestbps": None, "chol": 300, "thalch": 151},
        {"sex": "m", "age": 42, "num": None, "trestbps": 130.0, "chol": None, "thalch": 150},
    )
    (row,) = gold.demographics_summary(rows).collect()
    assert row.asDict() == {
        "sex": "Male",
        "age_group": "40-49",
        "patient_count": 3,
        "avg_age": 127 / 3,
        "heart_disease_count": 1,
        "heart_disease_percentage": 33.33,
        "avg_blood_pressure": 125.0,
        "avg_cholesterol": 250.0,
        "avg_max_heart_rate": 451 / 3,
        "created_at": row["created_at"],
    }
    assert row["created_at"] is not None


def test_severity_labels_null_group_and_total(make_bronze):
    rows = stage(make_bronze, *[{"num": n} for n in (None, None, 0, 1, 2, 3, 4, 5)])
    result = gold.in_order(gold.severity_distribution(rows), "gold_severity_distribution").collect()
    assert [(r[0], r[1], r[2], r[3]) for r in result] == [
        (0, "No Disease", 1, 12.5),
        (1, "Mild", 1, 12.5),
        (2, "Moderate", 1, 12.5),
        (3, "Severe", 1, 12.5),
        (4, "Very Severe", 1, 12.5),
        (5, None, 1, 12.5),
        (None, None, 2, 25.0),
    ]


def test_shares_sum_to_about_100(clean):
    total = gold.severity_distribution(clean).agg(F.sum("percentage")).first()[0]
    assert total == pytest.approx(100, abs=0.05)


def test_median_is_interpolated_and_ignores_nulls(make_bronze):
    rows = stage(make_bronze, *[{"chol": c, "sex": "m"} for c in (1, 2, None, 10, 20)])
    row = gold.clinical_metrics(rows).first()
    assert row["median_cholesterol"] == 6.0
    assert (row["min_cholesterol"], row["max_cholesterol"], row["avg_cholesterol"]) == (1, 20, 8.25)
    assert row["total_patients"] == 5
    assert row["median_resting_bp"] is None and row["avg_resting_bp"] is None
    assert row["high_fasting_sugar_count"] == 0


def test_measure_metrics_against_brute_force_with_a_hot_group(spark):
    rng = random.Random(7)
    data = [
        (
            None if rng.random() < 0.1 else ("hot" if rng.random() < 0.5 else f"g{rng.randrange(9)}"),
            rng.choice([None, *range(-20, 20)]),
            rng.randrange(1000),
            rng.choice([None, True, False]),
            rng.randrange(64) / 8,
        )
        for _ in range(4000)
    ]
    df = spark.createDataFrame(data, "k string, a int, b int, f boolean, d double")
    result = measure_metrics(
        df,
        ["k"],
        {"a": "a", "b": "b"},
        averages={"avg_d": "d"},
        maxima={"max_d": "d"},
        conditional_counts={"f_count": "f"},
    ).collect()

    groups = defaultdict(list)
    for row in data:
        groups[row[0]].append(row)
    assert len(result) == len(groups)
    for row in result:
        rows = groups[row["k"]]
        assert row["n"] == len(rows)
        for i, name in ((1, "a"), (2, "b")):
            values = [r[i] for r in rows if r[i] is not None]
            assert row[f"avg_{name}"] == sum(values) / len(values)
            assert row[f"min_{name}"] == min(values)
            assert row[f"max_{name}"] == max(values)
            assert row[f"median_{name}"] == statistics.median(values)
        assert row["f_count"] == sum(r[3] is True for r in rows)
        assert row["avg_d"] == sum(r[4] for r in rows) / len(rows)
        assert row["max_d"] == max(r[4] for r in rows)


@pytest.mark.parametrize("kind", ["int", "bigint"])
@pytest.mark.parametrize("span", [3, 70_000, 2**31 - 1, 2**50])
def test_exact_medians_against_brute_force(spark, span, kind):
    if kind == "int" and span > 2**31:
        pytest.skip("beyond int")
    rng = random.Random(span)
    data = [
        (
            rng.choice(["hot", "hot", "hot", None, "a"]),
            rng.randrange(2),
            None if rng.random() < 0.1 else rng.randrange(-span - 1, span),
        )
        for _ in range(3001)
    ]
    data += [("one", 0, -7), ("two", 0, -span - 1), ("two", 0, span), ("none", 0, None)]
    df = spark.createDataFrame(data, f"k string, j int, x {kind}")
    result = {(r[0], r[1]): r[2] for r in exact_medians(df, ["k", "j"], "x", "m").collect()}

    groups = defaultdict(list)
    for k, j, x in data:
        if x is not None:
            groups[k, j].append(x)
    assert result == {key: float(statistics.median(values)) for key, values in groups.items()}


def test_one_column_under_two_suffixes(spark):
    df = spark.createDataFrame([("a", 1), ("a", 4), (None, 7), ("b", None)], "k string, x smallint")
    result = measure_metrics(df, ["k"], {"p": "x", "q": "x"})
    values = {r["k"]: tuple(r)[1:] for r in result.collect()}
    assert values == {
        "a": (2, *(2.5, 1, 4, 2.5) * 2),
        None: (1, *(7.0, 7, 7, 7.0) * 2),
        "b": (1, *(None,) * 8),
    }


@pytest.mark.parametrize(("data", "expected"), [
    ([(2**40,), (None,), (-(2**40),), (6,)], (4, 2.0, -(2**40), 2**40, 6.0)),
    ([], (0, None, None, None, None)),
])
def test_metrics_without_keys(spark, data, expected):
    df = spark.createDataFrame(data, "x bigint")
    assert [tuple(r) for r in measure_metrics(df, [], {"x": "x"}).collect()] == [expected]
    medians = [tuple(r) for r in exact_medians(df, [], "x", "m").collect()]
    assert medians == ([expected[-1:]] if data else [])


def test_extremes_of_bigint(spark):
    df = spark.createDataFrame([(2**63 - 1,), (-(2**63),), (0,)], "x bigint")
    assert exact_medians(df, [], "x", "m").first()["m"] == 0.0


def test_medians_need_a_whole_number_type(spark):
    df = spark.createDataFrame([(1, 0.5)], "k int, x double")
    with pytest.raises(ValueError, match="double"):
        measure_metrics(df, ["k"], {"x": "x"})


@pytest.mark.parametrize("measures", [{"b": "b"}, {"a": "a", "b": "b", "c": "c", "d": "d"}])
def test_measure_metrics_with_any_number_of_measures(spark, measures):
    df = spark.createDataFrame([(1, 2, 3, 4)] * 3, "a int, b int, c int, d int").withColumn("k", F.lit(1))
    row = measure_metrics(df, ["k"], measures).first()
    assert row["n"] == 3
    assert [row[f"median_{name}"] for name in measures] == ["abcd".index(n) + 1.0 for n in measures]


def test_share_of_total_keeps_null_keys(spark):
    df = spark.createDataFrame([("a",), ("a",), (None,), ("b",)], "k string")
    rows = {r["k"]: (r["n"], r["percentage"]) for r in share_of_total(df, ["k"]).collect()}
    assert rows == {"a": (2, 50.0), None: (1, 25.0), "b": (1, 25.0)}


def test_top_rows_put_nulls_last_both_ways(spark):
    df = spark.createDataFrame([(1,), (None,), (3,)], "x int")
    assert [r[0] for r in top_rows(df, 3, "x").collect()] == [1, 3, None]
    assert [r[0] for r in top_rows(df, 2, "-x").collect()] == [3, 1]


def test_top_risk_needs_ten_patients(make_bronze):
    rows = [{"cp": "asymptomatic", "num": 1}] * 9 + [{"cp": "typical", "num": n % 2} for n in range(10)]
    result = views.top_risk_view(gold.risk_factors(stage(make_bronze, *rows))).collect()
    assert [tuple(r) for r in result] == [("Typical Angina", None, 10, 5, 50.0)]


def test_top_risk_breaks_ties_by_size(make_bronze):
    rows = [{"cp": "asymptomatic", "num": 1}] * 10 + [{"cp": "typical", "num": 1}] * 11
    result = views.top_risk_view(gold.risk_factors(stage(make_bronze, *rows)), n=1).collect()
    assert [(r[0], r[2]) for r in result] == [("Typical Angina", 11)]


def test_views_round_and_limit(clean):
    rows = views.demographics_view(gold.demographics_summary(clean)).collect()
    assert len(rows) == 10
    assert [(r[0], r[1]) for r in rows] == sorted((r[0], r[1]) for r in rows)
    assert all(round(r["avg_bp"], 1) == r["avg_bp"] for r in rows)
    assert views.severity_view(gold.severity_distribution(clean)).columns == [
        "severity_label",
        "patient_count",
        "percentage",
        "avg_age",
    ]


def test_scores_stay_in_range_and_fact_keeps_every_row(clean):
    fact = gold.fact_table(clean)
    low, high, rows = fact.agg(
        F.min("calculated_risk_score"), F.max("calculated_risk_score"), F.count(F.lit(1))
    ).first()
    assert 0 <= low <= high <= 18
    assert rows == clean.count()
    assert fact.columns[-2:] == ["calculated_risk_score", "created_at"]


@pytest.mark.parametrize("table", list(gold.BUILDERS))
def test_builders_on_empty_input(clean, table):
    assert gold.BUILDERS[table](clean.filter("false")).count() == 0


@pytest.mark.parametrize("table", list(gold.SORT_KEYS))
def test_reading_order(clean, table):
    rows = gold.in_order(gold.BUILDERS[table](clean), table).collect()
    for key in gold.SORT_KEYS[table][:1]:
        values = [r[key.lstrip("-")] for r in rows if r[key.lstrip("-")] is not None]
        assert values == sorted(values, reverse=key.startswith("-"))
