from __future__ import annotations

import datetime as dt
import os
import shutil
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from orderlens.sources.schema import SALES_COLUMNS, SALES_SCHEMA  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    shared = tmp_path_factory.mktemp("shared")
    session = (
        SparkSession.builder.master("local[4]")
        .appName("orderlens-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.default.parallelism", "4")
        .config("spark.driver.memory", "4g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.checkpoint.dir", str(shared))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
    shutil.rmtree(shared)


@pytest.fixture
def raw(spark):
    """Make records in the CSV layout from dicts of the fields that matter."""

    def make(*rows: dict[str, str | None]):
        return spark.createDataFrame([tuple(row.get(name) for name in SALES_COLUMNS) for row in rows], SALES_SCHEMA)

    return make


def day(text: str) -> dt.date:
    return dt.date.fromisoformat(text)


def rows_of(df) -> set:
    return {tuple(row) for row in df.collect()}
