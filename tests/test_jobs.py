from __future__ import annotations

from pathlib import Path

import pytest

from checks.fixture import patients
from triptych import config
from triptych.operators import ordered, quality_stats, table_counts
from triptych.plans import gold, jobs, silver, views
from triptych.sources import (
    LOST,
    manifest,
    read_csv,
    read_table,
    stored_counts,
    table_path,
    write_csv,
    write_table,
)
from tests.conftest import SPARK_ERRORS


@pytest.fixture(scope="module")
def source(spark, orders, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("source") / "patients.csv")
    write_csv(patients(orders), path)
    return path


@pytest.fixture(scope="module")
def full(spark, source, tmp_path_factory):
    return jobs.run_all(spark, source, str(tmp_path_factory.mktemp("base")), source_file="key.csv")


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_full_run_counts_match_the_stored_tables(spark, full):
    stored = table_counts(jobs.stored_tables(spark, full.base))
    assert rows(stored) == rows(full.record_counts(spark))
    assert list(full.counts) == list(config.LAYER_PATHS)
    assert stored.dtypes == full.record_counts(spark).dtypes
    assert full.counts[config.FACT_TABLE] == full.counts[config.SILVER_TABLE]


def test_observed_quality_equals_the_report(spark, full, bronze_rows):
    assert rows(full.quality_report(spark)) == rows(views.quality_report(bronze_rows))
    stats = quality_stats(
        silver.validated(silver.standardized(silver.typed(bronze_rows)))
    ).first()
    assert stats["records_with_issues"] + stats["clean_records"] == stats["total_records"]
    assert stats["clean_records"] == full.counts[config.SILVER_TABLE]


def test_stored_tables_equal_the_lazy_ones(spark, full, bronze_rows):
    clean = silver.clean(silver.validated(silver.standardized(silver.typed(bronze_rows))))
    clocks = ("ingestion_timestamp", "validation_timestamp", "created_at", "source_file")
    assert rows(read_table(spark, full.base, config.SILVER_TABLE).drop(*clocks)) == rows(
        clean.drop(*clocks)
    )
    for table, build in gold.BUILDERS.items():
        stored = read_table(spark, full.base, table)
        assert rows(stored.drop(*clocks)) == rows(build(clean).drop(*clocks))
        assert stored.columns == build(clean).columns


def test_stored_tables_as_sql_views(spark, full):
    views.register_views(jobs.stored_tables(spark, full.base))
    for table, count in full.counts.items():
        assert spark.sql(f"SELECT count(*) FROM {table}").first()[0] == count
    for view in config.STAGE_VIEWS:
        assert spark.table(view).count() == full.counts[config.BRONZE_TABLE]


def test_ingestion_time_is_stored_once(spark, full):
    bronze_table = read_table(spark, full.base, config.BRONZE_TABLE)
    assert bronze_table.select("ingestion_timestamp").distinct().count() == 1
    assert {r[0] for r in bronze_table.select("source_file").distinct().collect()} == {"key.csv"}


def test_export_holds_the_fact_table_only_by_default(spark, full):
    (path,) = full.exported
    assert path.endswith("/Export/gold_powerbi_fact_table.csv")
    fact = read_table(spark, full.base, config.FACT_TABLE)
    assert rows(read_csv(spark, path, fact.schema)) == rows(fact)


@pytest.mark.parametrize("table", [config.SEVERITY_TABLE, config.DEMOGRAPHICS_TABLE, config.FACT_TABLE])
def test_ordered_export_is_sorted_across_files(spark, full, tmp_path, table):
    spark.conf.set("spark.sql.adaptive.enabled", False)  # else few rows make one file
    try:
        (path,) = jobs.export_csv(spark, full.base, str(tmp_path), [table], in_order=True)
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    stored = read_table(spark, full.base, table)
    files = sorted(map(str, Path(path).glob("part-*.csv")))
    assert len(files) > 1
    exported = [tuple(r) for file in files for r in read_csv(spark, file, stored.schema).collect()]
    assert exported == [tuple(r) for r in ordered(stored, *gold.EXPORT_KEYS[table]).collect()]


def test_export_layout_does_not_depend_on_the_rows(spark, tmp_path):
    for n in (8, 20_000):
        base = f"{tmp_path}/{n}"
        rows_ = spark.range(n).repartition(4).selectExpr("CAST(id AS INT) AS patient_id")
        write_table(rows_, base, config.FACT_TABLE)
        spark.conf.set("spark.sql.files.openCostInBytes", "1g")  # one file a task
        (path,) = jobs.export_csv(spark, base)
        spark.conf.unset("spark.sql.files.openCostInBytes")
        assert len(list(Path(path).glob("part-*.csv"))) == 4


@pytest.mark.parametrize("layer", ["silver", "gold"])
def test_a_failed_run_keeps_the_earlier_tables(spark, source, tmp_path, monkeypatch, layer):
    base = str(tmp_path)
    jobs.run_all(spark, source, base, export=False)
    before = {t: rows(df) for t, df in jobs.stored_tables(spark, base).items()}
    if layer == "silver":
        columns = [("sex", "patient_id", "int"), *config.SILVER_COLUMNS[1:]]
        with pytest.raises(SPARK_ERRORS):
            jobs.run_silver(spark, base, columns=columns)
    else:
        failing = {**gold.BUILDERS, config.SEVERITY_TABLE: lambda df: df.selectExpr("CAST(sex AS INT) AS x")}
        monkeypatch.setattr(gold, "BUILDERS", failing)
        with pytest.raises(SPARK_ERRORS):
            jobs.run_gold(spark, base)
    spark.catalog.clearCache()
    assert {t: rows(df) for t, df in jobs.stored_tables(spark, base).items()} == before


def test_separator_and_quoted_line_breaks(spark, tmp_path):
    path = tmp_path / "odd.csv"
    names = ";".join(config.SOURCE_SCHEMA.names)
    path.write_text(f'{names}\n1; 63;"m\nx";;;120;233.0;1;;150;0;;;;;0\n')
    base = str(tmp_path / "base")
    jobs.run_bronze(spark, str(path), base, sep=";", multiline=True)
    (row,) = read_table(spark, base, config.BRONZE_TABLE).collect()
    assert (row.age, row.sex, row.chol, row.fbs, row.exang) == (63, "m\nx", 233, True, False)


def test_gold_can_be_run_again_on_stored_silver(spark, full):
    again = jobs.run_gold(spark, full.base, parallel=1)
    assert again.counts == {t: full.counts[t] for t in gold.BUILDERS}


@pytest.mark.parametrize(("layer", "tables"), [("bronze", 1), ("silver", 2)])
def test_layers(spark, source, tmp_path, layer, tables):
    result = jobs.run_all(spark, source, str(tmp_path), layer=layer)
    assert len(result.counts) == tables
    assert result.exported == []
    assert (tmp_path / "Silver").exists() == (layer == "silver")
    assert not (tmp_path / "Gold").exists()
    assert bool(result.quality) == (layer == "silver")


def test_inferred_types_give_the_same_silver_rows(spark, source, full, tmp_path):
    jobs.run_all(spark, source, str(tmp_path), layer="silver", infer_schema=True)
    inferred = read_table(spark, str(tmp_path), config.SILVER_TABLE)
    stored = read_table(spark, full.base, config.SILVER_TABLE)
    clocks = ("ingestion_timestamp", "validation_timestamp", "source_file")
    assert inferred.dtypes == stored.dtypes
    assert rows(inferred.drop(*clocks)) == rows(stored.drop(*clocks))


def test_ids_beyond_int_need_another_type(spark, tmp_path):
    path = tmp_path / "big.csv"
    path.write_text(",".join(config.SOURCE_SCHEMA.names) + "\n" + f"{2**40}" + "," * 15 + "\n")
    base = str(tmp_path / "base")
    jobs.run_bronze(spark, str(path), base)
    with pytest.raises(SPARK_ERRORS):
        jobs.run_silver(spark, base)
    columns = [("id", "patient_id", "bigint"), *config.SILVER_COLUMNS[1:]]
    jobs.run_silver(spark, base, columns=columns)
    jobs.run_gold(spark, base)
    assert read_table(spark, base, config.FACT_TABLE).first()["patient_id"] == 2**40


def test_unknown_layer(spark, source, tmp_path):
    with pytest.raises(ValueError):
        jobs.run_all(spark, source, str(tmp_path), layer="platinum")


def test_full_run_without_export(spark, source, tmp_path):
    assert jobs.run_all(spark, source, str(tmp_path), export=False).exported == []
    assert not (tmp_path / "Export").exists()


def test_errors_are_raised(spark, tmp_path):
    bad = tmp_path / "bad.csv"
    bad.write_text(",".join(config.SOURCE_SCHEMA.names) + "\n" + "1,?" + "," * 14 + "\n")
    with pytest.raises(SPARK_ERRORS):
        jobs.run_bronze(spark, str(bad), str(tmp_path / "base"))
    lenient = jobs.run_all(spark, str(bad), str(tmp_path / "base"), on_error="null")
    assert lenient.counts[config.SILVER_TABLE] == 1
    assert lenient.quality["null_critical_records"] == 1
    assert lenient.rejects == {"malformed_lines": 0, "lost_values": 1, "lost_casts": 0}
    (row,) = read_table(spark, str(tmp_path / "base"), config.REJECTS_TABLE).collect()
    assert (row.id, row.age, row[LOST]) == (1, None, {"age": "?"})


def test_rejects_of_an_earlier_run_go_with_it(spark, source, tmp_path):
    bad = tmp_path / "bad.csv"
    bad.write_text(",".join(config.SOURCE_SCHEMA.names) + "\n" + "1,2,surplus" + "," * 15 + "\n" + "2,3\n")
    base = str(tmp_path / "base")
    assert jobs.run_bronze(spark, str(bad), base, on_error="null").rejects == {"malformed_lines": 2, "lost_values": 0}
    assert read_table(spark, base, config.REJECTS_TABLE).count() == 2
    clean = jobs.run_bronze(spark, source, base, on_error="null")
    assert clean.rejects == {"malformed_lines": 0, "lost_values": 0}
    assert config.REJECTS_TABLE not in manifest(spark, base)


def test_lenient_silver_counts_lost_casts(spark, tmp_path):
    path = tmp_path / "big.csv"
    path.write_text(",".join(config.SOURCE_SCHEMA.names) + "\n" + f"{2**40}" + "," * 15 + "\n" + "7" + "," * 15 + "\n")
    base = str(tmp_path / "base")
    result = jobs.run_all(spark, str(path), base, layer="silver", on_error="null")
    assert result.rejects == {"malformed_lines": 0, "lost_values": 0, "lost_casts": 1}


def test_run_without_saving(spark, source, full, tmp_path):
    result = jobs.run_all(spark, source, None, save=False, export=False, source_file="key.csv")
    assert (result.counts, result.quality) == (full.counts, full.quality)
    assert not list(tmp_path.iterdir())
    assert not spark.sparkContext._jsc.getPersistentRDDs()
    with jobs.unsaved_run(spark, source, source_file="key.csv") as (tables, _):
        clocks = ("ingestion_timestamp", "validation_timestamp", "created_at")
        for table, stored in jobs.stored_tables(spark, full.base).items():
            assert rows(tables[table].drop(*clocks)) == rows(stored.drop(*clocks))
    with pytest.raises(ValueError):
        jobs.run_all(spark, source, None, layer="silver", save=False)


def test_export_of_an_unsaved_run(spark, source, full, tmp_path):
    (path,) = jobs.run_all(spark, source, str(tmp_path), save=False, source_file="key.csv").exported
    assert [p.name for p in tmp_path.iterdir()] == ["Export"]
    fact = read_table(spark, full.base, config.FACT_TABLE)
    assert rows(read_csv(spark, path, fact.schema).drop("created_at")) == rows(fact.drop("created_at"))


def test_gold_becomes_current_at_once(spark, source, tmp_path, monkeypatch):
    """Stopped after any number of gold tables are written, readers keep the old ones."""
    base = str(tmp_path)
    jobs.run_all(spark, source, base, export=False)
    before = manifest(spark, base)
    stage = jobs.stage_table
    for stop_at in range(len(gold.BUILDERS)):
        left = [stop_at]

        def stopping(df, base, table):
            if not left[0]:
                raise KeyboardInterrupt
            left[0] -= 1
            return stage(df, base, table)

        monkeypatch.setattr(jobs, "stage_table", stopping)
        with pytest.raises(KeyboardInterrupt):
            jobs.run_gold(spark, base, parallel=1)
        assert manifest(spark, base) == before
    monkeypatch.setattr(jobs, "stage_table", stage)
    jobs.run_gold(spark, base)
    after = manifest(spark, base)
    assert all((after[t] == before[t]) == (t not in gold.BUILDERS) for t in before)


def test_counts_come_from_the_commit(spark, full):
    assert rows(stored_counts(spark, full.base)) == rows(full.record_counts(spark))


def test_catalog_run_leaves_existing_tables(spark, bronze_rows, tmp_path):
    spark.sql(f"CREATE DATABASE layers LOCATION '{tmp_path}'")
    assert all(jobs.create_tables(bronze_rows, "layers", str(tmp_path)).values())
    before = {t: spark.table(f"layers.{t}").count() for t in config.LAYER_PATHS}
    again = jobs.create_tables(bronze_rows.filter("id < 100"), "layers", str(tmp_path))
    assert not any(again.values())
    assert {t: spark.table(f"layers.{t}").count() for t in config.LAYER_PATHS} == before
    spark.sql(f"DROP TABLE layers.{config.SEVERITY_TABLE}")
    once_more = jobs.create_tables(bronze_rows, "layers", str(tmp_path))
    assert [t for t, written in once_more.items() if written] == [config.SEVERITY_TABLE]
    replaced = jobs.create_tables(bronze_rows.filter("id < 100"), "layers", str(tmp_path), replace=True)
    assert all(replaced.values()) and spark.table(f"layers.{config.BRONZE_TABLE}").count() == 100
    spark.sql("DROP DATABASE layers CASCADE")


def test_source_file_defaults_to_the_path(spark, source, tmp_path):
    jobs.run_bronze(spark, source, str(tmp_path))
    names = read_table(spark, str(tmp_path), config.BRONZE_TABLE).select("source_file").distinct()
    assert all(source in row[0] for row in names.collect())


def test_empty_source(spark, tmp_path):
    path = tmp_path / "empty.csv"
    path.write_text(",".join(config.SOURCE_SCHEMA.names) + "\n")
    result = jobs.run_all(spark, str(path), str(tmp_path / "base"))
    assert set(result.counts.values()) == {0}
    assert table_path(result.base, config.FACT_TABLE).startswith(str(tmp_path))


def test_quality_sums_are_null_without_input(make_bronze):
    empty = silver.validated(silver.standardized(silver.typed(make_bronze({})))).filter("false")
    assert tuple(quality_stats(empty).first()) == (0, None, None)


def test_command_line(spark, source, tmp_path, capfd):
    from triptych.__main__ import main

    main([source, str(tmp_path), "--no-export", "--source-file", "key.csv"])
    shown = capfd.readouterr().out
    for text in ("Unique_Patients", "trestbps", "Clean Records in Silver", "70+", "risk_percentage", "gold_powerbi_fact_table"):
        assert text in shown
    assert not (tmp_path / "Export").exists()
