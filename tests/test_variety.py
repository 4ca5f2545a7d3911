from __future__ import annotations

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F
from tests.conftest import rows_of

from orderlens.operators import variety
from orderlens.operators.checks import observed_profile
from orderlens.plans import variety_medians, variety_quality, variety_records

SCHEMA = "month string, state string, style string, sku string, size string"


def frame(spark, *rows):
    return spark.createDataFrame(rows, SCHEMA)


def test_qualifying_styles_ignore_everything_but_size(spark):
    df = frame(spark, (None, "", "A", None, "XXL"), ("2022-01", "S", "B", "b", "XL"), ("2022-01", "S", "", "c", "3XL"),
               (None, "S", None, "d", "XXL"), ("2022-01", "S", "C", "c", "10XL"))
    assert rows_of(variety.qualifying_styles(df)) == {("A",)}


def test_median_of_odd_and_even_numbers_of_styles(spark):
    rows = []
    for state, counts in {"ODD": (1, 5, 2), "EVEN": (1, 4)}.items():
        for i, count in enumerate(counts):
            style = f"{state}{i}"
            rows += [("2022-01", state, style, f"{style}-{k}", "XXL" if k == 0 else "S") for k in range(count)]
            rows += [("2022-01", state, style, f"{style}-0", "M")]
    assert rows_of(variety.median_variety(frame(spark, *rows))) == {
        ("2022-01", "ODD", 2.0), ("2022-01", "EVEN", 2.5),
    }


def test_style_qualified_elsewhere_counts_here(spark):
    rows = [(None, "X", "A", "a9", "XXL"), ("2022-01", "X", "A", "a1", "S"), ("2022-01", "X", "A", "a2", "S"),
            ("2022-01", "X", "B", "b1", "S"), ("2022-01", "", "A", "a3", "S"), ("2022-01", "X", "A", "", "S")]
    assert rows_of(variety.median_variety(frame(spark, *rows))) == {("2022-01", "X", 2.0)}


def test_given_styles_and_other_columns(spark):
    rows = [("2022-01", "X", "A", "a1", "S"), ("2022-01", "X", "B", "b1", "S"), ("2022-01", "X", "B", "b2", "S")]
    styles = spark.createDataFrame([("B",), ("B",)], "style string")
    assert rows_of(variety.median_variety(frame(spark, *rows), styles=styles)) == {("2022-01", "X", 2.0)}
    found = variety.median_variety(frame(spark, *rows), group="size", qualifies=F.col("sku") == "a1")
    assert rows_of(found) == {("2022-01", "S", 1.0)}


def record(date, state, style, sku, size, status="Cancelled"):
    return {"Date": date, "ship-state": state, "Style": style, "SKU": sku, "Size": size, "Status": status}


RECORDS = (
    record("01-15-22", " tamil   nadu", "jne1", "k-1", "XXL"),
    record("01-16-22", "TAMIL NADU", " JNE1 ", "K-1", "S"),
    record("01-17-22", "Tamil Nadu", "Jne1", "k-2", "S"),
    record("xx", "GOA", "big", "k-3", "4XL"),
    record("02-01-22", "GOA", "BIG", "k-4", "S"),
    record("02-01-22", "GOA", "small", "k-5", "XL"),
    record("02-01-22", "", "BIG", "k-6", "S"),
)


def test_from_text_records(raw):
    assert rows_of(variety_records(raw(*RECORDS[:1]))) == {("2022-01", "TAMIL NADU", "JNE1", "K-1", "XXL")}
    assert rows_of(variety_medians(raw(*RECORDS))) == {("2022-01", "TAMIL NADU", 2.0), ("2022-02", "GOA", 1.0)}


def test_quality(raw):
    assert dict(rows_of(variety_quality(raw(*RECORDS)))) == {
        "QUALIFYING_XXL_ROWS": 2, "BAD_DATE_ROWS": 1, "MISSING_GROUP_FIELDS": 1, "QUALIFIED_STYLE_ROWS": 4,
    }


def test_one_read_of_the_records(spark, tmp_path):
    path = str(tmp_path / "records")
    frame(spark, ("2022-01", "S", "A", "a", "XXL"), ("2022-02", "S", "A", "b", "S"), ("2022-02", "S", "B", "c", "S")).write.parquet(path)
    medians = variety.median_variety(spark.read.parquet(path))
    assert rows_of(medians) == {("2022-01", "S", 1.0), ("2022-02", "S", 1.0)}
    plan = medians._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert plan.count("FileScan") == 1 and "Join" not in plan


def test_counters_come_with_the_run(spark, raw):
    counters = Observation()
    medians = rows_of(variety_medians(raw(*RECORDS), counters=counters))
    assert medians == rows_of(variety_medians(raw(*RECORDS)))
    assert rows_of(observed_profile(spark, counters)) == rows_of(variety_quality(raw(*RECORDS)))
    records = variety_records(raw(*RECORDS))
    with pytest.raises(ValueError):
        variety.median_variety(records, styles=records.select("style"), counters=Observation())
