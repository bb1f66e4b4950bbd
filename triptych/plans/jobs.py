"""The jobs that write the layers.

Each layer is read back from its stored table, so a lost executor costs the tasks
it ran and never an earlier layer.  Row counts are observed while the tables are
written, in the tasks that write them: no job runs only to count.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from triptych import config
from triptych.config import RangeRule
from triptych.operators import known_counts, ordered, table_counts
from triptych.plans import bronze, gold, silver, views
from triptych.sources import (
    LOST,
    MALFORMED,
    StoredTable,
    create_table,
    publish_tables,
    read_csv,
    read_table,
    read_tables,
    stage_table,
    write_csv,
)


@dataclass
class JobResult:
    """What a job made: row counts per table, the quality metrics of silver, what lenient reading lost."""

    base: str | None
    counts: dict[str, int] = field(default_factory=dict)
    quality: dict[str, int] = field(default_factory=dict)
    exported: list[str] = field(default_factory=list)
    #: malformed_lines and lost_values of a lenient bronze job, lost_casts of a lenient silver job.
    rejects: dict[str, int] = field(default_factory=dict)

    def record_counts(self, spark: SparkSession) -> DataFrame:
        return known_counts(spark, self.counts)

    def bronze_stats(self, spark: SparkSession) -> DataFrame:
        """Rows, distinct ids and ingestion time of the stored bronze table."""
        return bronze.stats(read_table(spark, self.base, config.BRONZE_TABLE))

    def quality_report(self, spark: SparkSession) -> DataFrame:
        rows = [(label, self.quality[name]) for label, name in views.QUALITY_METRICS.items()]
        return spark.createDataFrame(rows, "metric string, value bigint")


def run_bronze(
    spark: SparkSession,
    source: str | list[str],
    base: str,
    *,
    schema: T.StructType = config.SOURCE_SCHEMA,
    source_file: str | None = None,
    infer_schema: bool = False,
    on_error: str = "raise",
    sep: str = ",",
    multiline: bool = False,
) -> JobResult:
    """CSV to the bronze table.

    Lenient reading (``on_error="null"``) counts malformed lines and values that became
    null in the pass that writes bronze.  Only if there are any, a second pass stores
    those rows, with the line or the lost texts, in the rejects table of the same commit.
    """
    rows = read_csv(
        spark,
        source,
        schema,
        sep=sep,
        multiline=multiline,
        infer_schema=infer_schema,
        on_error=on_error,
        with_rejects=True,
    )
    audited = bronze.with_audit(rows, source_file)
    if LOST not in audited.columns:
        staged = stage_table(audited, base, config.BRONZE_TABLE)
        publish_tables(spark, base, [staged], removed=[config.REJECTS_TABLE])
        return JobResult(base, {staged.table: staged.rows})

    lost = Observation()
    counted = audited.observe(
        lost,
        F.count(MALFORMED).alias("malformed_lines"),
        F.coalesce(F.sum(F.size(LOST)), F.lit(0)).cast("bigint").alias("lost_values"),
    )
    staged = [stage_table(counted.drop(MALFORMED, LOST), base, config.BRONZE_TABLE)]
    rejects = dict(lost.get)
    if any(rejects.values()):
        bad = audited.filter(F.col(MALFORMED).isNotNull() | (F.size(LOST) > 0))
        staged.append(stage_table(bad, base, config.REJECTS_TABLE))
    removed = [config.REJECTS_TABLE] if len(staged) == 1 else []
    publish_tables(spark, base, staged, removed=removed)
    return JobResult(base, {config.BRONZE_TABLE: staged[0].rows}, rejects=rejects)


def run_silver(
    spark: SparkSession,
    base: str,
    *,
    rules: Sequence[RangeRule] = config.RANGE_RULES,
    columns: Sequence[tuple[str, str, str]] = config.SILVER_COLUMNS,
    on_error: str = "raise",
) -> JobResult:
    """Bronze table to silver table: one pass without a shuffle, metrics included.

    Pass other ``columns`` to change a type, for instance to bigint for ids that
    no longer fit an int.  With ``on_error="null"`` the values that these casts lose
    are counted too.
    """
    stored = read_table(spark, base, config.BRONZE_TABLE)
    quality, rejects = Observation(), {}
    if on_error == "null":
        lost = Observation()
        stored = stored.observe(lost, silver.lost_casts(stored, columns).alias("lost_casts"))
    checked = silver.checked(stored, rules, columns=columns, on_error=on_error).observe(
        quality, *silver.quality_metrics()
    )
    staged = stage_table(silver.clean(checked).drop("has_null_critical"), base, config.SILVER_TABLE)
    metrics = quality.get
    if on_error == "null":
        rejects = dict(lost.get)
    publish_tables(spark, base, [staged])
    return JobResult(base, {staged.table: staged.rows}, metrics, rejects=rejects)


def run_gold(spark: SparkSession, base: str, *, parallel: int = len(gold.BUILDERS)) -> JobResult:
    """Silver table to the gold tables, which become current together.

    Each table scans only its own columns of silver.  The writes run side by side,
    so that the short reduce stages of one leave no executor idle.
    """
    clean = read_table(spark, base, config.SILVER_TABLE)

    def build(table: str) -> StoredTable:
        return stage_table(gold.BUILDERS[table](clean), base, table)

    with ThreadPoolExecutor(max_workers=parallel) as pool:
        jobs = [pool.submit(inheritable_thread_target(spark)(build), table) for table in gold.BUILDERS]
        staged = [job.result() for job in jobs]
    publish_tables(spark, base, staged)
    return JobResult(base, {entry.table: entry.rows for entry in staged})


def export_csv(
    spark: SparkSession,
    base: str,
    target: str | None = None,
    tables: Sequence[str] = (config.FACT_TABLE,),
    in_order: bool = False,
) -> list[str]:
    """Stored tables as CSV folders for BI tools; by default the fact table.

    The layout is the same for few and many rows: split files.  With ``in_order`` their
    rows are sorted across all files: ranges of the reading order are dealt to tasks,
    each of which sorts its own, and files read by name are in order.
    """
    stored = read_tables(spark, base, tables)
    return _export(stored, target or f"{base.rstrip('/')}/Export", in_order)


def _export(tables: dict[str, DataFrame], target: str, in_order: bool = False) -> list[str]:
    paths = []
    for table, rows in tables.items():
        paths.append(f"{target.rstrip('/')}/{table}.csv")
        write_csv(ordered(rows, *gold.EXPORT_KEYS[table]) if in_order else rows, paths[-1])
    return paths


@contextmanager
def unsaved_run(
    spark: SparkSession,
    source: str | list[str],
    *,
    rules: Sequence[RangeRule] = config.RANGE_RULES,
    source_file: str | None = None,
    **reading,
) -> Iterator[tuple[dict[str, DataFrame], JobResult]]:
    """All layers without storing a table: (tables, result), good inside the ``with`` block.

    The CSV is read and validated once; the checked rows are kept by executors, in
    memory and on their disks, for the silver table, the metrics and the five gold
    tables, and are let go at the end.  An executor lost meanwhile costs reading its
    part of the CSV again.  ``reading`` are options of ``read_csv``.
    """
    on_error = reading.get("on_error", "raise")
    rows = bronze.with_audit(read_csv(spark, source, **reading), source_file)
    checked = silver.checked(rows, rules, on_error=on_error).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        quality = checked.agg(*silver.quality_metrics()).first().asDict()
        clean = silver.clean(checked).drop("has_null_critical")
        tables = {config.BRONZE_TABLE: rows, config.SILVER_TABLE: clean}
        tables |= {table: build(clean) for table, build in gold.BUILDERS.items()}
        result = JobResult(None, quality=quality)
        result.counts = {
            config.BRONZE_TABLE: quality["total_records"],
            config.SILVER_TABLE: quality["clean_records"],
        }
        grouped = {table: tables[table] for table in gold.BUILDERS if table != config.FACT_TABLE}
        result.counts |= {row["layer"]: row["record_count"] for row in table_counts(grouped).collect()}
        result.counts[config.FACT_TABLE] = quality["clean_records"]
        yield tables, result
    finally:
        checked.unpersist()


LAYERS = ("bronze", "silver", "full")


def run_all(
    spark: SparkSession,
    source: str | list[str],
    base: str | None,
    *,
    layer: str = "full",
    save: bool = True,
    export: bool = True,
    source_file: str | None = None,
    infer_schema: bool = False,
    on_error: str = "raise",
    sep: str = ",",
    multiline: bool = False,
) -> JobResult:
    """Every layer up to ``layer``; with ``"full"`` also the CSV export.

    ``save=False`` runs all layers without storing their tables; ``base`` is then the
    place of the export only, and may be None without one.
    """
    if layer not in LAYERS:
        raise ValueError(f"layer must be one of {', '.join(LAYERS)}, not {layer!r}")
    reading = {"infer_schema": infer_schema, "on_error": on_error, "sep": sep, "multiline": multiline}
    if not save:
        if layer != "full":
            raise ValueError("a run without saving goes through all layers")
        with unsaved_run(spark, source, source_file=source_file, **reading) as (tables, result):
            if export:
                fact = {config.FACT_TABLE: tables[config.FACT_TABLE]}
                result.exported = _export(fact, f"{base.rstrip('/')}/Export")
        return result

    result = run_bronze(spark, source, base, source_file=source_file, **reading)
    if layer == "bronze":
        return result

    step = run_silver(spark, base, on_error=on_error)
    result.counts.update(step.counts)
    result.rejects.update(step.rejects)
    result.quality = step.quality
    if layer == "silver":
        return result

    result.counts.update(run_gold(spark, base).counts)
    if export:
        result.exported = export_csv(spark, base)
    return result


def create_tables(
    rows: DataFrame, database: str, location: str, *, replace: bool = False
) -> dict[str, bool]:
    """All layers as catalog tables of ``database``, from audited bronze rows.

    Every table is made from the stored one before it.  One that exists is left as it
    is, and nothing is computed for it, unless ``replace`` is set.  The result says which
    tables were written.
    """
    spark = rows.sparkSession

    def create(table: str, df: DataFrame) -> bool:
        return create_table(df, f"{database}.{table}", f"{location.rstrip('/')}/{config.LAYER_PATHS[table]}", replace=replace)

    written = {config.BRONZE_TABLE: create(config.BRONZE_TABLE, rows)}
    checked = silver.checked(spark.table(f"{database}.{config.BRONZE_TABLE}"))
    clean = silver.clean(checked).drop("has_null_critical")
    written[config.SILVER_TABLE] = create(config.SILVER_TABLE, clean)
    stored = spark.table(f"{database}.{config.SILVER_TABLE}")
    for table, build in gold.BUILDERS.items():
        written[table] = create(table, build(stored))
    return written


def stored_tables(spark: SparkSession, base: str) -> dict[str, DataFrame]:
    """Every layer table that a full run leaves under ``base``, all of one commit."""
    return read_tables(spark, base, config.LAYER_PATHS)
