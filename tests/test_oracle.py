"""Every registered query against its SQL, and the driver contract."""

from __future__ import annotations

import pytest

import __spark_entry__ as contract
from checks.catalog import CLOCKS, QUERIES
from checks.compare import differences, duckdb_tables
from checks.oracle import ORACLE_SQL
from tests.conftest import SF_DIR


@pytest.fixture(scope="module")
def connection():
    return duckdb_tables(SF_DIR)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, connection, name):
    assert differences(spark, connection, SF_DIR, name) == []


def test_contract(spark):
    assert QUERIES.keys() == ORACLE_SQL.keys()
    assert QUERIES.items() <= contract.queries().items()
    assert ORACLE_SQL.items() <= contract.oracle_sql().items()
    assert contract.oracle_sql().keys() <= contract.queries().keys()
    result = contract.entry(spark)
    assert result.count() > 0
    assert not set(CLOCKS) & set(result.columns)
