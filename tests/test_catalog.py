"""Every catalog entry against its SQL on the smallest tables."""

from __future__ import annotations

import math
import pathlib

import duckdb
import pytest

import __spark_entry__ as contract
from orderlens.catalog import ENTRIES

FOLDER = pathlib.Path("/root/testdata/sf0.001")
NAMES = sorted(ENTRIES)

pytestmark = pytest.mark.skipif(not FOLDER.exists(), reason="test tables are not here")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    connection.execute("SET timezone = 'UTC'")
    for path in FOLDER.glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


def shape(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    return str(value)


def table(columns, rows):
    order = [columns.index(name) for name in sorted(columns)]
    return sorted(tuple(shape(row[i]) for i in order) for row in rows)


def test_every_entry_has_its_sql():
    assert set(NAMES) <= set(contract.oracle_sql())
    assert set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", NAMES)
def test_same_rows_as_sql(spark, duck, name):
    df = contract.queries()[name](spark, str(FOLDER))
    answer = duck.execute(contract.oracle_sql()[name])
    columns = [c[0] for c in answer.description]
    assert sorted(df.columns) == sorted(columns)
    assert table(df.columns, df.collect()) == table(columns, answer.fetchall())


def test_entry(spark):
    df = contract.entry(spark)
    assert df.columns == ["state", "window_date", "most_bought_size", "frequency", "population_variance"]
    assert df.count() > 0
