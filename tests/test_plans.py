"""What the physical plans must and must not contain."""

from __future__ import annotations

import contextlib
import io
import re

import pytest

from triptych import config
from triptych.plans import gold, jobs, silver, views
from triptych.sources import read_table, write_csv

from checks.catalog import QUERIES
from checks.fixture import patients
from tests.conftest import SF_DIR


@pytest.fixture(scope="module")
def base(spark, orders, tmp_path_factory):
    folder = tmp_path_factory.mktemp("plans")
    write_csv(patients(orders), f"{folder}/source")
    jobs.run_all(spark, f"{folder}/source", str(folder), export=False)
    return str(folder)


@pytest.fixture(scope="module")
def clean(spark, base):
    return read_table(spark, base, config.SILVER_TABLE)


def plan(df) -> str:
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain("formatted")
    return text.getvalue()


def exchanges(df) -> list[str]:
    return re.findall(r"^Arguments: (hashpartitioning|SinglePartition|rangepartitioning)", plan(df), re.M)


WITH_MEDIANS = (
    "gold_clinical_metrics",
    "lineitem_metrics",
    "orders_price_metrics",
    "lineitem_price_metrics",
)


def final_scans(df) -> int:
    """Scans that the adaptive plan ran, after reuse of exchanges."""
    df.collect()
    tree = plan(df).split("== Final Plan ==")[1].split("== Initial Plan ==")[0]
    return tree.count("Scan parquet")


@pytest.mark.parametrize("name", list(QUERIES))
def test_no_python_and_no_product(spark, name):
    text = plan(QUERIES[name](spark, SF_DIR))
    for operator in ("Python", "Pandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert operator not in text
    assert ("Window" in text) == (name in WITH_MEDIANS)


@pytest.mark.parametrize(
    ("table", "expected"),
    [
        (config.DEMOGRAPHICS_TABLE, ["hashpartitioning"]),
        (config.RISK_FACTORS_TABLE, ["hashpartitioning"]),
        # The total comes from the same shuffle once more, which the adaptive plan reuses; the
        # single partition holds one partial total per task of the grouped rows.
        (config.SEVERITY_TABLE, ["hashpartitioning", "hashpartitioning", "SinglePartition"]),
        (config.FACT_TABLE, []),
    ],
)
def test_shuffles_of_the_gold_tables(clean, table, expected):
    assert exchanges(gold.BUILDERS[table](clean)) == expected


def test_medians_rank_buckets_within_groups(spark):
    text = plan(QUERIES["orders_price_metrics"](spark, SF_DIR))
    windows = re.findall(r"^Arguments: \[.*windowspecdefinition\((.*?)\)", text, re.M)
    assert windows and all(spec.startswith("o_orderpriority") for spec in windows)
    assert "partial_count" in text


@pytest.mark.parametrize("name", WITH_MEDIANS)
def test_medians_of_all_measures_share_one_scan(spark, name):
    """One scan for the plain aggregates, one for all values."""
    assert final_scans(QUERIES[name](spark, SF_DIR)) == 2


def test_counts_of_stages_take_one_scan(spark):
    assert final_scans(QUERIES["stage_counts"](spark, SF_DIR)) == 1


def test_record_counts_read_no_table(spark):
    text = plan(QUERIES["record_counts"](spark, SF_DIR))
    assert "Scan parquet" not in text and "Exchange" not in text


@pytest.mark.parametrize("name", ["gold_severity", "events_share"])
def test_share_and_total_share_one_scan(spark, name):
    """Rows that are not stored are read and grouped once, also for the total."""
    df = QUERIES[name](spark, SF_DIR)
    assert final_scans(df) == 1
    assert "ReusedExchange" in plan(df).split("===== Subqueries =====")[1]


def test_distinct_ids_travel_as_bitmaps(spark, base):
    from triptych.plans import bronze

    stored = read_table(spark, base, config.BRONZE_TABLE)
    text = plan(bronze.stats(stored))
    assert "partial_bitmap_construct_agg" in text
    assert exchanges(bronze.stats(stored)) == ["hashpartitioning", "SinglePartition"]
    assert "hashpartitioning(_groupingexpression" in text and "bitmapBucketNumber(id" in text
    assert "bitmap" not in plan(bronze.stats(stored, dense=False))


def test_medians_take_one_level_where_the_values_fit(spark, clean):
    """Count per value, rank within the group: no bucket of buckets, no join."""
    text = plan(gold.clinical_metrics(clean))
    assert "Join" not in text
    assert "Join" in plan(QUERIES["orders_price_metrics"](spark, SF_DIR))


def test_partial_aggregation_before_every_group_shuffle(clean):
    for table in (config.DEMOGRAPHICS_TABLE, config.RISK_FACTORS_TABLE, config.CLINICAL_TABLE):
        text = plan(gold.BUILDERS[table](clean))
        assert "partial_count" in text


def test_silver_is_one_pass_without_a_shuffle(spark, base):
    rows = silver.clean(silver.checked(read_table(spark, base, config.BRONZE_TABLE)))
    text = plan(rows)
    assert text.count("Scan parquet") == 2  # once in the tree, once in the details
    assert "Exchange" not in text


@pytest.mark.parametrize(
    ("table", "columns"),
    [
        (config.RISK_FACTORS_TABLE, {*gold.RISK_FACTORS, "has_heart_disease"}),
        (
            config.SEVERITY_TABLE,
            {"age", "cholesterol", "resting_blood_pressure", "heart_disease_severity"},
        ),
    ],
)
def test_only_needed_columns_are_read(clean, table, columns):
    schemas = re.findall(r"ReadSchema: struct<(.*)>", plan(gold.BUILDERS[table](clean)))
    assert all({c.split(":")[0] for c in schema.split(",")} == columns for schema in schemas)


def test_quality_report_scans_bronze_once(spark, base):
    text = plan(views.quality_report(read_table(spark, base, config.BRONZE_TABLE)))
    (schema,) = re.findall(r"ReadSchema: struct<(.*)>", text)
    names = {c.split(":")[0] for c in schema.split(",")}
    assert names == {"age", "sex", "trestbps", "chol", "thalch", "oldpeak"}


def test_record_counts_read_no_columns(spark, base):
    from triptych.operators import table_counts

    text = plan(table_counts(jobs.stored_tables(spark, base)))
    assert set(re.findall(r"ReadSchema: struct<(.*)>", text)) == {""}


def test_top_k_does_not_sort_everything(clean):
    text = plan(views.top_risk_view(gold.risk_factors(clean)))
    assert "TakeOrderedAndProject" in text
    assert "rangepartitioning" not in text


def test_stored_silver_stages_stay_below_the_jit_limit(spark, base):
    rows = silver.clean(silver.checked(read_table(spark, base, config.BRONZE_TABLE)))
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        rows.explain("codegen")
    sizes = [int(size) for size in re.findall(r"maxMethodCodeSize:(\d+)", text.getvalue())]
    assert sizes and max(sizes) < 8000
