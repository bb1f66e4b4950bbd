"""The registered queries: name -> function of (session, folder of test tables).

Each runs over whole tables.  Clock columns differ between runs and are dropped.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce, wraps

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from checks.fixture import patients
from triptych import config
from triptych.config import RangeRule
from triptych.functions import additive_score, breaks_any, bucketize, label_by_part, to_int, to_type
from triptych.operators import measure_metrics, ordered, reports, share_of_total, table_counts
from triptych.plans import bronze, gold, jobs, silver, views
from triptych.session import scratch_dir
from triptych.sources import LOST, MALFORMED, read_csv, read_table, stored_counts, write_csv, write_table

CLOCKS = ("ingestion_timestamp", "validation_timestamp", "created_at")

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def _query(function: Callable[[SparkSession, str], DataFrame]):
    @wraps(function)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return function(spark, sf_dir).drop(*CLOCKS)

    QUERIES[function.__name__] = run
    return run


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _source(spark: SparkSession, sf_dir: str) -> DataFrame:
    return patients(_table(spark, sf_dir, "orders"))


def _bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bronze.with_audit(_source(spark, sf_dir), "orders")


def _standardized(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _bronze(spark, sf_dir).transform(silver.typed).transform(silver.standardized)


def _validated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _standardized(spark, sf_dir).transform(silver.validated)


def _clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _validated(spark, sf_dir).transform(silver.clean)


_bases: dict[tuple[str, str], str] = {}


def _stored_base(spark: SparkSession, sf_dir: str) -> str:
    """Where the jobs have stored all layers; they run once per application and folder."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _bases:
        base = scratch_dir(spark)
        write_table(_bronze(spark, sf_dir), base, config.BRONZE_TABLE)
        jobs.run_silver(spark, base)
        jobs.run_gold(spark, base)
        _bases[key] = base
    return _bases[key]


def _stored(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return jobs.stored_tables(spark, _stored_base(spark, sf_dir))


# --- bronze -----------------------------------------------------------------------


@_query
def bronze_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _bronze(spark, sf_dir)


@_query
def bronze_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bronze.stats(_bronze(spark, sf_dir)).drop("Ingestion_Time")


@_query
def bronze_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.bronze_preview(_bronze(spark, sf_dir))


# --- silver -----------------------------------------------------------------------


@_query
def silver_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.typed(_bronze(spark, sf_dir))


@_query
def silver_typed_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same casts from a source whose columns are all text."""
    rows = _bronze(spark, sf_dir)
    text = rows.select(*[F.col(n).cast("string") for n in config.SOURCE_SCHEMA.names], "source_file")
    return silver.typed(text, keep=("source_file",))


@_query
def silver_standardized(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _standardized(spark, sf_dir)


@_query
def silver_validated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _validated(spark, sf_dir)


@_query
def silver_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _clean(spark, sf_dir)


@_query
def silver_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.preview(_standardized(spark, sf_dir))


@_query
def stage_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows after each stage, in one scan: only cleaning drops any."""
    stats = reports.quality_stats(_validated(spark, sf_dir))
    stages = {name: "total_records" for name in ("typed", "standardized", "validated")}
    stages["clean"] = F.coalesce("clean_records", F.lit(0)).cast("bigint")
    return reports.as_metric_rows(stats, stages, "stage", "record_count")


@_query
def quality_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.quality_stats(_validated(spark, sf_dir))


@_query
def quality_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.quality_report(_bronze(spark, sf_dir))


@_query
def age_group_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.age_group_distribution(_clean(spark, sf_dir))


@_query
def sql_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SQL over the stage views."""
    views.register_views({config.BRONZE_TABLE: _bronze(spark, sf_dir)})
    return spark.sql(
        """SELECT sex, has_quality_issues, COUNT(*) AS n, MAX(max_heart_rate) AS top_rate
        FROM silver_stage3_validated GROUP BY sex, has_quality_issues"""
    )


# --- gold -------------------------------------------------------------------------


def _gold(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return gold.in_order(gold.BUILDERS[table](_clean(spark, sf_dir)), table)


@_query
def gold_demographics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _gold(spark, sf_dir, config.DEMOGRAPHICS_TABLE)


@_query
def gold_risk_factors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _gold(spark, sf_dir, config.RISK_FACTORS_TABLE)


@_query
def gold_severity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _gold(spark, sf_dir, config.SEVERITY_TABLE)


@_query
def gold_clinical_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _gold(spark, sf_dir, config.CLINICAL_TABLE)


@_query
def gold_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _gold(spark, sf_dir, config.FACT_TABLE)


@_query
def record_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the stored tables, as their commit states them."""
    return stored_counts(spark, _stored_base(spark, sf_dir))


@_query
def view_demographics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.demographics_view(gold.demographics_summary(_clean(spark, sf_dir)))


@_query
def view_top_risk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.top_risk_view(gold.risk_factors(_clean(spark, sf_dir)))


@_query
def view_severity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.severity_view(gold.severity_distribution(_clean(spark, sf_dir)))


# --- stored tables ----------------------------------------------------------------


@_query
def parquet_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver and the fact table, each written and read back."""
    base = scratch_dir(spark)
    write_table(_clean(spark, sf_dir), base, config.SILVER_TABLE)
    fact = gold.fact_table(read_table(spark, base, config.SILVER_TABLE))
    write_table(fact, base, config.FACT_TABLE)
    return read_table(spark, base, config.FACT_TABLE)


@_query
def stored_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stored(spark, sf_dir)[config.BRONZE_TABLE]


@_query
def stored_demographics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stored(spark, sf_dir)[config.DEMOGRAPHICS_TABLE]


@_query
def stored_risk_factors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stored(spark, sf_dir)[config.RISK_FACTORS_TABLE]


@_query
def stored_severity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stored(spark, sf_dir)[config.SEVERITY_TABLE]


@_query
def stored_clinical(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stored(spark, sf_dir)[config.CLINICAL_TABLE]


@_query
def audit_clocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether the stored clocks are set, hold one value a table, and follow each other."""
    seen = [
        table.agg(
            F.lit(clock).alias("clock"),
            F.count(F.lit(1)).alias("rows"),
            F.count(clock).alias("set"),
            F.min(clock).alias("low"),
            F.max(clock).alias("high"),
        )
        for table in _stored(spark, sf_dir).values()
        for clock in CLOCKS
        if clock in table.columns
    ]

    def of(clock: str, column: str) -> Column:
        return F.when(F.col("clock") == clock, F.col(column))

    return reduce(DataFrame.unionByName, seen).agg(
        F.sum("rows").alias("clock_values"),
        F.bool_and(F.col("rows") == F.col("set")).alias("all_set"),
        F.bool_and(F.col("low") == F.col("high")).alias("one_value_a_table"),
        (F.max(of(CLOCKS[0], "high")) <= F.min(of(CLOCKS[1], "low"))).alias("ingested_first"),
        (F.max(of(CLOCKS[1], "high")) <= F.min(of(CLOCKS[2], "low"))).alias("created_last"),
    )


@_query
def csv_loose_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole numbers like ``233.0`` and `` 63``, booleans like ``1`` in a CSV file."""
    path = scratch_dir(spark)
    loose = _source(spark, sf_dir).withColumns(
        {
            "age": F.concat(F.lit(" "), "age"),
            "chol": F.concat("chol", F.lit(".0")),
            "fbs": F.col("fbs").cast("int"),
        }
    )
    write_csv(loose, path)
    return read_csv(spark, path)


@_query
def csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark)
    write_csv(_source(spark, sf_dir), path)
    return read_csv(spark, path)


@_query
def csv_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What lenient reading could not keep of a file with ragged lines and bad values."""
    base = scratch_dir(spark)
    names = config.SOURCE_SCHEMA.names
    rows = _source(spark, sf_dir)
    bad = {
        "age": F.when(F.col("id") % 5 == 2, F.lit("old")).otherwise(F.col("age").cast("string")),
        "ca": F.when(F.col("id") % 13 == 3, F.lit("n/a")).otherwise(F.col("ca").cast("string")),
    }
    fields = [F.coalesce(F.col(name).cast("string"), F.lit("")) for name in names]
    whole, short = F.concat_ws(",", *fields), F.concat_ws(",", *fields[:14])
    line = (
        F.when(F.col("id") % 7 == 0, F.concat(whole, F.lit(",surplus")))
        .when(F.col("id") % 11 == 1, short)
        .otherwise(whole)
    )
    # A single column that is named and filled like a whole line.
    write_csv(rows.withColumns(bad).select(line.alias(",".join(names))), f"{base}/source", sep="\x01")
    result = jobs.run_bronze(spark, f"{base}/source", base, source_file="orders", on_error="null")
    lost = F.transform(F.map_entries(LOST), lambda e: F.concat_ws("=", e["key"], e["value"]))
    return read_table(spark, base, config.REJECTS_TABLE).select(
        "id",
        F.col(MALFORMED).alias("line"),
        F.array_join(F.array_sort(lost), ";").alias("lost"),
        *[F.lit(n).cast("bigint").alias(name) for name, n in result.rejects.items()],
    )


@_query
def csv_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fact table exported as sorted CSV files and read back."""
    base = scratch_dir(spark)
    fact = gold.fact_table(_clean(spark, sf_dir))
    write_table(fact, base, config.FACT_TABLE)
    (path,) = jobs.export_csv(spark, base, in_order=True)
    return read_csv(spark, path, fact.schema)


@_query
def full_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CSV to bronze, silver, gold and export; then the counts of the stored tables."""
    base = scratch_dir(spark)
    source = f"{base}/source"
    write_csv(_source(spark, sf_dir), source)
    jobs.run_all(spark, source, base, source_file="orders")
    return table_counts(jobs.stored_tables(spark, base))


@_query
def full_run_unsaved(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CSV through all layers without storing any; the counts of what was made."""
    source = f"{scratch_dir(spark)}/source"
    write_csv(_source(spark, sf_dir), source)
    result = jobs.run_all(spark, source, None, save=False, export=False, source_file="orders")
    return result.record_counts(spark)


@_query
def catalog_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All layers as catalog tables; a second run finds them and leaves them as they are."""
    base = scratch_dir(spark)
    database = base.rpartition("/")[2].replace("-", "_")
    spark.sql(f"CREATE DATABASE {database} LOCATION '{base}'")
    first, again = (jobs.create_tables(_bronze(spark, sf_dir), database, base) for _ in range(2))
    counts = table_counts({table: spark.table(f"{database}.{table}") for table in first})
    written = F.create_map(*[F.lit(x) for table in first for x in (table, int(first[table]) + int(again[table]))])
    return counts.withColumn("times_written", written[F.col("layer")])


# --- the same operators on other tables -------------------------------------------

LINEITEM_RULES = (
    RangeRule("l_quantity", 2, 48),
    RangeRule("l_discount", 0.01, 0.09),
    RangeRule("l_tax", 0.0, 0.07),
)


@_query
def orders_standardized(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = (("Rush", ("urgent", "high")), ("Normal", ("medium",)), ("Slow", ("low",)))
    label = label_by_part(F.col("o_orderpriority"), rules, "Unknown")
    return _table(spark, sf_dir, "orders").select("o_orderkey", label.alias("priority"))


@_query
def lineitem_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "lineitem")
    return reports.quality_stats(rows.select(breaks_any(LINEITEM_RULES).alias("has_quality_issues")))


@_query
def orders_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    bucket = bucketize(
        F.col("o_totalprice"),
        (50_000, 150_000, 300_000),
        ("small", "medium", "large", "huge"),
        "none",
    )
    orders = _table(spark, sf_dir, "orders").select(bucket.alias("size"))
    return ordered(orders.groupBy("size").agg(F.count(F.lit(1)).alias("n")), "size")


@_query
def events_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    shares = share_of_total(_table(spark, sf_dir, "events"), ["event_type"])
    return ordered(shares, "event_type")


@_query
def lineitem_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    double = T.DoubleType()
    rows = _table(spark, sf_dir, "lineitem").select(
        "l_returnflag",
        "l_linestatus",
        to_int(F.col("l_quantity"), double).alias("quantity"),
        to_int(F.col("l_discount") * 100, double).alias("discount_percent"),
        (F.col("l_tax") > 0.04).alias("is_high_tax"),
    )
    metrics = measure_metrics(
        rows,
        ["l_returnflag", "l_linestatus"],
        {"quantity": "quantity", "discount": "discount_percent"},
        averages={"mean_quantity": "quantity"},
        maxima={"top_discount": "discount_percent"},
        conditional_counts={"high_tax_count": "is_high_tax"},
    )
    return ordered(metrics, "l_returnflag", "l_linestatus")


@_query
def orders_price_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A measure of wide range: prices in cents."""
    cents = to_int(F.col("o_totalprice") * 100, T.DoubleType()).alias("cents")
    metrics = measure_metrics(
        _table(spark, sf_dir, "orders").select("o_orderpriority", cents),
        ["o_orderpriority"],
        {"cents": "cents"},
    )
    return ordered(metrics, "o_orderpriority")


@_query
def lineitem_price_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A bigint measure: prices in cents."""
    cents = to_type(F.col("l_extendedprice") * 100, T.DoubleType(), "bigint").alias("cents")
    keys = ["l_returnflag", "l_linestatus"]
    metrics = measure_metrics(
        _table(spark, sf_dir, "lineitem").select(*keys, cents), keys, {"cents": "cents"}
    )
    return ordered(metrics, *keys)


@_query
def customer_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    terms = (
        ("c_acctbal > 5000", 2),
        ("c_acctbal < 0", 1),
        ("c_mktsegment = 'BUILDING'", 3),
        ("c_nationkey >= 12", 1),
    )
    return _table(spark, sf_dir, "customer").select("c_custkey", additive_score(terms).alias("score"))


SOURCE_TABLES = (
    "region",
    "nation",
    "customer",
    "supplier",
    "part",
    "orders",
    "lineitem",
    "events",
    "documents",
    "embeddings",
    "pages",
    "benchmark",
    "labels",
    "conversations",
)


@_query
def source_table_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table_counts({name: _table(spark, sf_dir, name) for name in SOURCE_TABLES})
