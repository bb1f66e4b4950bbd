"""Run the jobs with spark-submit or ``python -m triptych``."""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession

from triptych import config
from triptych.plans import bronze, jobs, views
from triptych.session import get_session
from triptych.sources import read_tables, write_csv


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="triptych", description=__doc__)
    parser.add_argument("source", help="URI of the CSV file or folder")
    parser.add_argument("base", help="URI below which the layer tables are written")
    parser.add_argument("--layer", choices=jobs.LAYERS, default="full", help="last layer to run")
    parser.add_argument("--no-save", action="store_true", help="store no tables, only export and report")
    parser.add_argument("--no-export", action="store_true", help="skip the CSV export")
    parser.add_argument("--infer-schema", action="store_true", help="take types from the data")
    parser.add_argument("--lenient", action="store_true", help="read bad values as null")
    parser.add_argument("--sep", default=",", help="separator of the CSV columns")
    parser.add_argument("--multiline", action="store_true", help="allow line breaks inside quotes")
    parser.add_argument("--source-file", help="name stored with each row instead of its file path")
    options = parser.parse_args(arguments)

    spark = get_session()
    reading = {
        "source_file": options.source_file,
        "infer_schema": options.infer_schema,
        "on_error": "null" if options.lenient else "raise",
        "sep": options.sep,
        "multiline": options.multiline,
    }
    if options.no_save:
        with jobs.unsaved_run(spark, options.source, **reading) as (tables, result):
            show(spark, tables, result)
            if not options.no_export:
                write_csv(tables[config.FACT_TABLE], f"{options.base.rstrip('/')}/Export/{config.FACT_TABLE}.csv")
        return
    result = jobs.run_all(
        spark, options.source, options.base, layer=options.layer, export=not options.no_export, **reading
    )
    show(spark, read_tables(spark, options.base, result.counts), result)


def show(spark: SparkSession, tables: dict[str, DataFrame], result: jobs.JobResult) -> None:
    """Print previews of the tables and the reports."""
    views.bronze_preview(tables[config.BRONZE_TABLE]).show()
    bronze.stats(tables[config.BRONZE_TABLE]).show(truncate=False)
    if result.rejects:
        print("Lost by lenient reading:", result.rejects)
    if result.quality:
        result.quality_report(spark).show(truncate=False)
        views.age_group_distribution(tables[config.SILVER_TABLE]).show()
    if config.FACT_TABLE in tables:
        views.demographics_view(tables[config.DEMOGRAPHICS_TABLE]).show()
        views.top_risk_view(tables[config.RISK_FACTORS_TABLE]).show()
        views.severity_view(tables[config.SEVERITY_TABLE]).show()
    result.record_counts(spark).show(truncate=False)


if __name__ == "__main__":
    main()
