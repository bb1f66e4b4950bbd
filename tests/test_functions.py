from __future__ import annotations

from decimal import Decimal

import duckdb
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from triptych.config import RangeRule
from triptych.functions import (
    additive_score,
    bucketize,
    label_by_alias,
    label_by_part,
    label_by_value,
    percent_of,
    positive_flag,
    round_half_away,
    to_int,
    to_type,
)
from tests.conftest import SPARK_ERRORS


def column(spark, values, kind):
    return spark.createDataFrame([(v,) for v in values], f"x {kind}")


def apply(df, expression):
    return [row[0] for row in df.select(expression).collect()]


@pytest.mark.parametrize(
    ("kind", "values", "expected"),
    [
        ("double", [2.5, 3.5, 2.7, -2.5, None], [2, 4, 3, -2, None]),
        ("float", [0.5, 1.5], [0, 2]),
        ("string", ["2.5", "3.5", "-2.5", "63.0", "1e3", " 5 ", None], [3, 4, -3, 63, 1000, 5, None]),
        ("decimal(5,1)", [Decimal("2.5"), Decimal("-2.5")], [3, -3]),
        ("bigint", [7, -7, None], [7, -7, None]),
        ("boolean", [True, False, None], [1, 0, None]),
    ],
)
def test_to_int_rounds(spark, kind, values, expected):
    df = column(spark, values, kind)
    assert apply(df, to_int(F.col("x"), df.schema["x"].dataType)) == expected


@pytest.mark.parametrize("text", ["?", "", "abc", "3000000000"])
def test_unreadable_text_fails_unless_lenient(spark, text):
    df = column(spark, [text, "1"], "string")
    with pytest.raises(SPARK_ERRORS):
        apply(df, to_int(F.col("x"), T.StringType()))
    assert apply(df, to_int(F.col("x"), T.StringType(), "null")) == [None, 1]


@pytest.mark.parametrize(
    ("kind", "values", "expected"),
    [
        ("double", [3e9, 2.5], [3_000_000_000, 2]),
        ("string", ["9223372036854775807", "2.5"], [9_223_372_036_854_775_807, 3]),
        ("bigint", [2**62], [2**62]),
    ],
)
def test_bigint_target_rounds_too(spark, kind, values, expected):
    df = column(spark, values, kind)
    assert apply(df, to_type(F.col("x"), df.schema["x"].dataType, "bigint")) == expected


@pytest.mark.parametrize("value", [3e9, float("nan"), float("inf")])
def test_doubles_outside_int_fail_unless_lenient(spark, value):
    df = column(spark, [value], "double")
    with pytest.raises(SPARK_ERRORS):
        apply(df, to_int(F.col("x"), T.DoubleType()))
    assert apply(df, to_int(F.col("x"), T.DoubleType(), "null")) == [None]


def test_to_type_boolean_and_bad_mode(spark):
    df = column(spark, ["TRUE", "f", "1", "no", "?"], "string")
    lenient = to_type(F.col("x"), T.StringType(), "boolean", "null")
    assert apply(df, lenient) == [True, False, True, False, None]
    with pytest.raises(ValueError):
        to_type(F.col("x"), T.StringType(), "int", "ignore")


def test_percentages_round_like_duckdb_on_every_pair(spark):
    pairs = spark.range(1, 301).select(F.explode(F.sequence(F.lit(0), F.col("id"))).alias("n"), F.col("id").alias("m"))
    ours = pairs.select("n", "m", percent_of(F.col("n"), F.col("m")).alias("p")).collect()
    theirs = duckdb.connect().sql(
        "SELECT n, m, round(n * 100.0 / m, 2) AS p FROM range(1, 301) t(m), range(0, 301) s(n) WHERE n <= m"
    ).fetchall()
    assert sorted(map(tuple, ours)) == sorted(theirs)


def test_rounding_scales_first(spark):
    values = [0.145, 0.575, 2.5, -0.145, -2.675, 1e17, None]
    df = column(spark, values, "double")
    expected = [
        duckdb.connect().execute("SELECT round(CAST(? AS DOUBLE), 2)", [v]).fetchone()[0] for v in values
    ]
    assert apply(df, round_half_away(F.col("x"), 2)) == expected
    assert expected[0] == 0.14


def test_23_of_4000(spark):
    row = spark.range(1).select(percent_of(F.lit(23), F.lit(4000)).alias("p")).first()
    assert row["p"] == 0.57


def test_label_by_alias(spark):
    df = column(spark, [" M ", "F", "1", "0", "x", None], "string")
    label = label_by_alias(F.col("x"), (("A", ("m", "1")), ("B", ("f", "0"))), "?")
    assert apply(df, label) == ["A", "B", "A", "B", "?", "?"]


def test_label_by_part_first_rule_wins_and_order_is_an_argument(spark):
    df = column(spark, ["Atypical", "TYPICAL", "none", None], "string")
    rules = (("T", ("typical",)), ("A", ("atypical",)))
    assert apply(df, label_by_part(F.col("x"), rules, "?")) == ["T", "T", "?", "?"]
    assert apply(df, label_by_part(F.col("x"), rules[::-1], "?")) == ["A", "T", "?", "?"]


def test_label_by_value(spark):
    df = column(spark, [0, 1, 5, -1, None], "int")
    assert apply(df, label_by_value(F.col("x"), ((0, "zero"), (1, "one")))) == [
        "zero",
        "one",
        None,
        None,
        None,
    ]


def test_bucketize_bounds_and_missing(spark):
    df = column(spark, [9, 10, 19, 20, None], "int")
    assert apply(df, bucketize(F.col("x"), (10, 20), ("a", "b", "c"), "?")) == ["a", "b", "b", "c", "?"]
    with pytest.raises(ValueError):
        bucketize(F.col("x"), (10,), ("a",), "?")
    with pytest.raises(ValueError):
        bucketize(F.col("x"), (20, 10), ("a", "b", "c"), "?")


def test_positive_flag(spark):
    df = column(spark, [-1, 0, 4, 5, None], "int")
    assert apply(df, positive_flag(F.col("x"))) == [None, False, True, True, None]


def test_additive_score_counts_null_as_zero(spark):
    df = column(spark, [5, 50, None], "int")
    assert apply(df, additive_score((("x > 1", 2), ("x > 10", 3)))) == [2, 5, 0]


@pytest.mark.parametrize("bounds", [(None, 1), ("0", 1), (2, 1), (True, 2)])
def test_range_rule_rejects_bad_bounds(bounds):
    with pytest.raises(ValueError):
        RangeRule("x", *bounds)
