"""Run every registered query and its SQL, and compare names, types and rows.

    python -m checks.compare [folder of test tables] [query ...]
"""

from __future__ import annotations

import sys
import time
from collections import Counter

import duckdb
import pyarrow as pa
from pyspark.sql import SparkSession

from checks.catalog import QUERIES, SOURCE_TABLES
from checks.oracle import ORACLE_SQL


def duckdb_tables(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in SOURCE_TABLES:
        connection.execute(
            f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')"
        )
    return connection


def _rows(table: pa.Table) -> Counter:
    names = sorted(table.column_names)
    return Counter(zip(*[table.column(name).to_pylist() for name in names]))


def _schema(table: pa.Table) -> dict[str, str]:
    return {f.name: str(f.type).replace("large_", "") for f in table.schema}


def differences(
    spark: SparkSession, connection: duckdb.DuckDBPyConnection, sf_dir: str, name: str
) -> list[str]:
    """What differs between the two sides; empty when they agree."""
    actual = QUERIES[name](spark, sf_dir).toArrow()
    expected = connection.sql(ORACLE_SQL[name]).to_arrow_table()
    found = []
    if _schema(actual) != _schema(expected):
        found.append(f"schema: {_schema(actual)} / {_schema(expected)}")
    if set(actual.column_names) == set(expected.column_names):
        left, right = _rows(actual), _rows(expected)
        if left != right:
            found.append(
                f"rows: {actual.num_rows} / {expected.num_rows}, only left"
                f" {list((left - right).items())[:2]}, only right {list((right - left).items())[:2]}"
            )
    return found


def main() -> None:
    from triptych.session import get_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = get_session(master="local[8]", **{"spark.sql.shuffle.partitions": "8"})
    spark.sparkContext.setLogLevel("ERROR")
    connection = duckdb_tables(sf_dir)
    bad = 0
    for name in sys.argv[2:] or QUERIES:
        start = time.perf_counter()
        found = differences(spark, connection, sf_dir, name)
        bad += bool(found)
        print(f"{'DIFF' if found else 'ok':5}{name} {time.perf_counter() - start:.2f}s", *found)
    sys.exit(bool(bad))


if __name__ == "__main__":
    main()
