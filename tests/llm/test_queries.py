"""The registered queries of this subpackage: those with SQL against it, and the driver contract."""

from __future__ import annotations

import inspect
import re

import pytest

import __spark_entry__ as contract
import corpus_pipeline
from checks.compare import _rows, _schema, duckdb_tables
from tests.conftest import SF_DIR
from triptych.llm import queries


@pytest.mark.parametrize("name", list(queries.ORACLE_SQL))
def test_query_equals_sql(spark, name):
    actual = queries.QUERIES[name](spark, SF_DIR).toArrow()
    expected = duckdb_tables(SF_DIR).sql(queries.ORACLE_SQL[name]).to_arrow_table()
    assert _schema(actual) == _schema(expected)
    assert _rows(actual) == _rows(expected)


def test_contract():
    assert {int(re.match(r"op(\d+)_", name)[1]) for name in queries.QUERIES} == set(range(1, 14))
    assert queries.ORACLE_SQL.keys() <= queries.QUERIES.keys()
    assert {**queries.QUERIES, "pipeline": corpus_pipeline.run}.items() <= contract.queries().items()
    assert queries.ORACLE_SQL.items() <= contract.oracle_sql().items()
    assert corpus_pipeline.ORACLE_SQL is None and "pipeline" not in contract.oracle_sql()
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language", "exact_dedup", "near_dedup", "mixing", "packing"]
    for _, stage in corpus_pipeline.STAGES:
        assert list(inspect.signature(stage).parameters) == ["spark", "docs", "sf_dir"]
