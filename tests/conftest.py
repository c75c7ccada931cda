from __future__ import annotations

import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from weekpanel.session import clear_scratch  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .appName("tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    clear_scratch(session)
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return "/root/testdata/sf0.001"


@pytest.fixture
def series(spark):
    """Build (id, week_start, interest) rows from lists of values, one row a week."""

    def build(**values):
        rows = [
            (int(name[1:]), week, None if v is None else float(v))
            for name, vs in values.items()
            for week, v in enumerate(vs)
        ]
        df = spark.createDataFrame(rows, "id bigint, week int, interest double")
        return df.selectExpr("id", "date_add(date'2024-01-01', 7 * week) as week_start", "interest")

    return build
