from __future__ import annotations

import os
import sys

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from triptych import config  # noqa: E402
from triptych.session import get_session  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"

# A failed task surfaces as one or the other, depending on the action.
SPARK_ERRORS = (PySparkException, Py4JJavaError)


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = get_session(
        "tests",
        master="local[*]",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.enabled": "false",
            # A test points spark.checkpoint.dir elsewhere for a while.
            "spark.sql.legacy.setCommandRejectsSparkCoreConfs": "false",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("scratch")),
        },
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def orders(spark):
    return spark.read.parquet(f"{SF_DIR}/orders.parquet")


@pytest.fixture(scope="session")
def bronze_rows(orders):
    from checks.fixture import patients
    from triptych.plans import bronze

    return bronze.with_audit(patients(orders), "orders")


@pytest.fixture
def make_bronze(spark):
    """Bronze rows from dictionaries; columns not named are null."""

    from triptych.plans import bronze

    def make(*rows: dict):
        names = config.SOURCE_SCHEMA.names
        data = [tuple(row.get(name) for name in names) for row in rows]
        return bronze.with_audit(spark.createDataFrame(data, config.SOURCE_SCHEMA), "test")

    return make


@pytest.fixture
def validate(make_bronze):
    """The rows after all silver stages, in the order given."""

    from triptych.plans import silver

    def run(*rows: dict):
        numbered = [{"id": i, **row} for i, row in enumerate(rows)]
        staged = (
            make_bronze(*numbered)
            .transform(silver.typed)
            .transform(silver.standardized)
            .transform(silver.validated)
        )
        return staged.orderBy("patient_id").collect()

    return run
