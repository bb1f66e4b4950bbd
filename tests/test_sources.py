from __future__ import annotations

import datetime as dt
from pathlib import Path

import duckdb
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from triptych import config
from triptych.operators import count_with_distinct
from triptych.operators.distinct import are_dense
from triptych.plans import bronze, silver
from triptych.session import scratch_dir
from triptych.sources import (
    LOST,
    MALFORMED,
    create_table,
    layers,
    manifest,
    publish_tables,
    read_csv,
    read_table,
    read_tables,
    stage_table,
    table_path,
    write_csv,
    write_table,
)
from tests.conftest import SPARK_ERRORS

SCHEMA = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("name", T.StringType()),
        T.StructField("score", T.DoubleType()),
        T.StructField("flag", T.BooleanType()),
    ]
)


@pytest.fixture
def csv_file(tmp_path):
    def write(text, name="in.csv"):
        path = tmp_path / name
        path.write_text(text)
        return str(path)

    return write


def rows(df):
    return [tuple(row) for row in df.collect()]


def test_values_nulls_quotes_and_blanks(spark, csv_file):
    path = csv_file('id,name,score,flag\n1," a ",2.5,TRUE\n2,"say ""x"", y",,false\n3,,1e3,\n4,"",,\n')
    expected = [
        (1, " a ", 2.5, True),
        (2, 'say "x", y', None, False),
        (3, None, 1000.0, None),
        (4, None, None, None),
    ]
    assert rows(read_csv(spark, path, SCHEMA)) == expected
    assert duckdb.connect().sql(f"SELECT * FROM read_csv('{path}', header = true)").fetchall() == expected


def test_columns_are_matched_by_name_and_unknown_ones_kept(spark, csv_file):
    df = read_csv(spark, csv_file("flag,extra,id,score,name\ntrue,007,1,2,a\n"), SCHEMA)
    assert df.dtypes == [
        ("flag", "boolean"),
        ("extra", "string"),
        ("id", "bigint"),
        ("score", "double"),
        ("name", "string"),
    ]
    assert rows(df) == [(True, "007", 1, 2.0, "a")]


def test_letter_case_of_the_header_does_not_matter(spark, tmp_path):
    path = tmp_path / "upper.csv"
    names = [name.upper() for name in config.SOURCE_SCHEMA.names]
    path.write_text(",".join(names) + "\n7,55,m,,,120.5,,,,,,,,,,\n")
    rows_read = bronze.with_audit(read_csv(spark, str(path)), "upper.csv")
    assert rows_read.columns[:16] == names
    row = silver.typed(rows_read).first()
    assert (row["patient_id"], row["age"], row["resting_blood_pressure"]) == (7, 55, 120)


def test_missing_column_is_an_error(spark, csv_file):
    with pytest.raises(ValueError, match="score"):
        read_csv(spark, csv_file("id,name,flag\n"), SCHEMA)


def test_files_with_another_header_are_an_error(spark, csv_file):
    first = csv_file("id,name,score,flag\n1,a,1,true\n", "1.csv")
    second = csv_file("id,score,name,flag\n2,2,b,true\n", "2.csv")
    with pytest.raises(SPARK_ERRORS):
        read_csv(spark, [first, second], SCHEMA).collect()


def test_missing_file_is_an_error(spark, tmp_path):
    with pytest.raises(SPARK_ERRORS):
        read_csv(spark, str(tmp_path / "none.csv"), SCHEMA)


def test_unreadable_value_fails_unless_lenient(spark, csv_file):
    path = csv_file("id,name,score,flag\n1,a,?,true\n")
    with pytest.raises(SPARK_ERRORS):
        read_csv(spark, path, SCHEMA).collect()
    assert rows(read_csv(spark, path, SCHEMA, on_error="null")) == [(1, "a", None, True)]
    with pytest.raises(ValueError):
        read_csv(spark, path, SCHEMA, on_error="drop")


def test_inferred_types(spark, csv_file):
    df = read_csv(spark, csv_file("a,b,c,d\n1,1.5,true,x\n2,,false,\n"), infer_schema=True)
    assert df.dtypes == [("a", "int"), ("b", "double"), ("c", "boolean"), ("d", "string")]


def test_inferred_types_need_equal_headers(spark, csv_file):
    paths = [csv_file("x,y\n1,2\n", "1.csv"), csv_file("y,x\n30,3\n", "2.csv")]
    with pytest.raises(SPARK_ERRORS):
        read_csv(spark, paths, infer_schema=True).collect()


def test_submitted_tuning_stays(spark):
    from triptych.session import get_session

    session = get_session(**{"spark.sql.files.maxPartitionBytes": "64m"})
    assert session.conf.get("spark.sql.files.maxPartitionBytes") == "64m"
    assert session.conf.get("spark.sql.session.timeZone") == "UTC"
    assert session.conf.get("spark.sql.ansi.enabled") == "true"


def test_other_separator(spark, csv_file):
    path = csv_file("id;name;score;flag\n1;a,b;2;true\n")
    assert rows(read_csv(spark, path, SCHEMA, sep=";")) == [(1, "a,b", 2.0, True)]


def test_line_breaks_inside_quotes(spark, csv_file):
    path = csv_file('id,name,score,flag\n1,"a\nb",1,true\n')
    assert rows(read_csv(spark, path, SCHEMA, multiline=True)) == [(1, "a\nb", 1.0, True)]


def test_csv_round_trip_keeps_text_and_microseconds(spark, tmp_path):
    schema = T.StructType([*SCHEMA.fields, T.StructField("seen", T.TimestampType())])
    data = [
        (1, ' a "b", c\\d ', 0.1, True, dt.datetime(2026, 12, 1, 15, 18, 2, 901358)),
        (2, None, None, None, None),
        (3, "\té", -1e300, False, dt.datetime(1999, 1, 1)),
    ]
    df = spark.createDataFrame(data, schema)
    path = str(tmp_path / "out.csv")
    write_csv(df, path)
    write_csv(df, path)  # a second run replaces the first
    back = read_csv(spark, path, schema)
    assert sorted(rows(back)) == sorted(rows(df))
    theirs = duckdb.connect().sql(
        f"SELECT id, name, score, flag, epoch_us(seen) FROM read_csv('{path}/*.csv', header = true,"
        " types = {'seen': 'TIMESTAMPTZ'}) ORDER BY id"
    ).fetchall()
    micros = df.orderBy("id").select("id", "name", "score", "flag", F.unix_micros("seen"))
    assert theirs == rows(micros)


def test_table_round_trip_and_layout(spark, bronze_rows, tmp_path):
    base = f"{tmp_path}/"
    path = write_table(bronze_rows, base, config.BRONZE_TABLE)
    folder, _, run = path.rpartition("/")
    assert folder == table_path(base, config.BRONZE_TABLE)
    assert folder == f"{tmp_path}/Bronze/bronze_layer_heart_data.parquet"
    files = list((tmp_path / "Bronze" / "bronze_layer_heart_data.parquet" / run).glob("*.snappy.parquet"))
    assert files
    back = read_table(spark, base, config.BRONZE_TABLE)
    assert back.dtypes == bronze_rows.dtypes
    assert back.count() == bronze_rows.count()


def two_tables(spark, n):
    return [(config.BRONZE_TABLE, spark.range(n)), (config.SILVER_TABLE, spark.range(2 * n))]


def seen(spark, base):
    tables = read_tables(spark, base)
    assert {t: df.count() for t, df in tables.items()} == {t: e.rows for t, e in manifest(spark, base).items()}
    return {table: df.count() for table, df in tables.items()}


def test_readers_find_a_whole_set_wherever_a_writer_stops(spark, tmp_path, monkeypatch):
    """Stop a second publication before each of its steps that touch files."""
    base = str(tmp_path)
    publish_tables(spark, base, [stage_table(df, base, table) for table, df in two_tables(spark, 5)])
    old = seen(spark, base)
    steps = ("create", "read", "names", "delete")
    for stop_at in range(12):
        publish_tables(spark, base, [stage_table(df, base, table) for table, df in two_tables(spark, 5)])
        staged = [stage_table(df, base, table) for table, df in two_tables(spark, 7)]
        assert seen(spark, base) == old
        left = [stop_at]

        def counted(original):
            def step(self, *args):
                if not left[0]:
                    raise KeyboardInterrupt
                left[0] -= 1
                return original(self, *args)

            return step

        with monkeypatch.context() as patch:
            for name in steps:
                patch.setattr(layers._Files, name, counted(getattr(layers._Files, name)))
            try:
                publish_tables(spark, base, staged)
                finished = True
            except KeyboardInterrupt:
                finished = False
        after = seen(spark, base)
        assert after in (old, {table: n // 5 * 7 for table, n in old.items()})
        if finished:
            assert after != old
            break
    else:
        raise AssertionError("never finished")
    publish_tables(spark, base, [stage_table(df, base, table) for table, df in two_tables(spark, 5)])
    assert seen(spark, base) == old


def test_an_incomplete_commit_does_not_count(spark, tmp_path):
    base = str(tmp_path)
    write_table(spark.range(3), base, config.BRONZE_TABLE)
    number = max(int(p.stem) for p in (tmp_path / "_commits").glob("[0-9]*.json"))
    (tmp_path / "_commits" / f"{number + 1:012d}.json").write_text('{"tables": {"bronze_heart')
    assert seen(spark, base) == {config.BRONZE_TABLE: 3}
    write_table(spark.range(4), base, config.BRONZE_TABLE)
    assert seen(spark, base) == {config.BRONZE_TABLE: 4}


def test_concurrent_commits_keep_both_tables(spark, tmp_path, monkeypatch):
    base = str(tmp_path)
    (bronze_name, rows), (silver_name, more) = two_tables(spark, 2)
    create = layers._Files.create
    other = stage_table(more, base, silver_name)

    def late(self, name, text):
        """Another job takes the number first."""
        monkeypatch.setattr(layers._Files, "create", create)
        publish_tables(spark, base, [other])
        return create(self, name, text)

    monkeypatch.setattr(layers._Files, "create", late)
    write_table(rows, base, bronze_name)
    assert seen(spark, base) == {bronze_name: 2, silver_name: 4}


def test_old_runs_are_dropped_once_two_commits_are_newer(spark, tmp_path):
    base = str(tmp_path)
    paths = [write_table(spark.range(n), base, config.BRONZE_TABLE) for n in range(1, 5)]
    assert [Path(path).exists() for path in paths] == [False, False, True, True]
    assert len(list((tmp_path / "_commits").glob("[0-9]*.json"))) == 2
    with pytest.raises(FileNotFoundError):
        read_table(spark, base, config.SILVER_TABLE)


def test_catalog_tables_are_created_if_missing(spark, tmp_path):
    spark.sql(f"CREATE DATABASE if_missing LOCATION '{tmp_path}'")
    name = "if_missing.numbers"
    assert create_table(spark.range(5), name, f"{tmp_path}/numbers")
    fails = spark.range(9).select(F.raise_error(F.lit("evaluated")).cast("bigint").alias("id"))
    assert not create_table(fails, name, f"{tmp_path}/numbers")
    assert spark.table(name).count() == 5
    with pytest.raises(SPARK_ERRORS):
        create_table(fails, name, f"{tmp_path}/numbers", replace=True)
    assert spark.table(name).count() == 5
    assert create_table(spark.range(9), name, f"{tmp_path}/numbers", replace=True)
    assert spark.table(name).count() == 9
    assert create_table(spark.range(2).selectExpr("id AS n"), name, f"{tmp_path}/numbers", replace=True)
    assert spark.table(name).columns == ["n"]
    spark.sql("DROP DATABASE if_missing CASCADE")


def test_rejects_of_lenient_reading(spark, csv_file):
    path = csv_file(
        "id,name,score,flag\n"
        "1,a,1.5,true\n"
        "x,b,1.5,maybe\n"
        "3,c,2.5,false,more,fields\n"
        "4,d\n"
        ",,,\n"
    )
    rows = read_csv(spark, path, SCHEMA, on_error="null", with_rejects=True).orderBy("name").collect()
    found = {row["name"]: (row[MALFORMED], row[LOST]) for row in rows}
    assert found["a"] == found[None] == (None, {})
    assert found["b"] == (None, {"id": "x", "flag": "maybe"})
    assert found["c"] == ("3,c,2.5,false,more,fields", {})
    assert found["d"] == ("4,d", {})
    assert read_csv(spark, path, SCHEMA, on_error="null").columns == ["id", "name", "score", "flag"]


def test_audit_columns(spark, csv_file):
    path = csv_file("id,name,score,flag\n1,a,1,true\n")
    source = read_csv(spark, path, SCHEMA)
    (row,) = bronze.with_audit(source, "in.csv").collect()
    assert row["source_file"] == "in.csv"
    assert isinstance(row["ingestion_timestamp"], dt.datetime)
    (row,) = bronze.with_audit(source).collect()
    assert row["source_file"].endswith("/in.csv")


def test_bronze_stats(make_bronze):
    df = make_bronze({"id": 1}, {"id": 1}, {"id": 2}, {})
    row = bronze.stats(df).first()
    assert row.asDict() == {
        "Total_Records": 4,
        "Unique_Patients": 2,
        "Ingestion_Time": row["Ingestion_Time"],
    }
    assert row["Ingestion_Time"] is not None


IDS = [0, 1, -1, 32_768, -32_768, -32_767, 32_769, 5, 5, None, None, 2**40, -(2**63), 2**63 - 1]


@pytest.mark.parametrize("dense", [None, True, False])
@pytest.mark.parametrize("ids", [IDS, [None], [], [3, 3, 4], list(range(-70_000, 70_000, 3)) * 2])
def test_distinct_ids_with_and_without_bitmaps(spark, ids, dense):
    df = spark.createDataFrame([(i, n) for n, i in enumerate(ids)], "id bigint, at int").repartition(3)
    found = count_with_distinct(df, "id", "ids", minima={"first": "at"}, dense=dense).first()
    expected = (len(ids), len({i for i in ids if i is not None}), 0 if ids else None)
    assert tuple(found) == expected


def test_bitmaps_are_chosen_for_dense_whole_numbers(spark):
    assert are_dense(spark.range(100_000), "id")
    assert not are_dense(spark.range(0, 10**15, 10**11), "id")
    assert not are_dense(spark.range(10).selectExpr("CAST(id AS STRING) AS id"), "id")


def test_scratch_is_below_the_shared_folder(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    assert scratch_dir(spark).startswith(f"{shared}/triptych-")
    assert scratch_dir(spark) != scratch_dir(spark)


def test_scratch_of_a_session_can_be_dropped(spark, tmp_path):
    from triptych import session

    kept = session._scratch.pop(spark.sparkContext.applicationId, [])
    before = spark.conf.get("spark.checkpoint.dir")
    spark.conf.set("spark.checkpoint.dir", str(tmp_path))
    try:
        spark.range(3).write.parquet(f"{scratch_dir(spark)}/table")
        assert [p.name.startswith("triptych-") for p in tmp_path.iterdir()] == [True]
        assert session.drop_scratch(spark) == 1
        assert not list(tmp_path.iterdir()) and session.drop_scratch(spark) == 0
    finally:
        spark.conf.set("spark.checkpoint.dir", before)
        session._scratch[spark.sparkContext.applicationId] = kept
