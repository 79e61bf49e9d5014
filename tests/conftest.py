"""One small session for all tests."""

from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from samples import BRAGA, RAW_DDL  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    session = (
        SparkSession.builder.master("local[8]")
        .appName("tests")
        .config("spark.sql.shuffle.partitions", "4")
        # a handful of rows: compiling takes longer than interpreting (tests/compare.py compiles)
        .config("spark.sql.codegen.wholeStage", "false")
        .config("spark.sql.codegen.factoryMode", "NO_CODEGEN")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "4g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def raw(spark):
    """Builds raw weather rows: changes to the Braga row, or whole rows."""

    def build(*rows, drop=()):
        names = [part.split(" ")[0] for part in RAW_DDL.split(", ")]
        whole = [dict(BRAGA, **row) for row in rows]
        df = spark.createDataFrame([tuple(r[n] for n in names) for r in whole], RAW_DDL)
        return df.drop(*drop)

    return build
