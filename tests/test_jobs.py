"""The jobs from file to file."""

from __future__ import annotations

import csv

import pytest
from tests.conftest import rows_of

from orderlens.plans import jobs
from orderlens.sources.schema import SALES_COLUMNS


@pytest.fixture
def source(tmp_path):
    """Forty records of two states; the first is followed by a second header and a short line."""
    path = tmp_path / "sales.csv"
    with path.open("w", newline="") as out:
        writer = csv.writer(out)
        writer.writerow(SALES_COLUMNS)
        for i in range(40):
            row = dict.fromkeys(SALES_COLUMNS, "")
            row |= {
                "index": str(i), "Order ID": f"o{i}", "Date": f"04-{1 + i % 5:02d}-22",
                "Status": "Shipped" if i % 2 else "Cancelled", "Fulfilment": "Merchant" if i % 2 else "Platform",
                "ship-service-level": "Standard", "Style": f"st{i % 4}", "SKU": f"sku{i % 8}",
                "Size": "XXL" if i % 4 == 0 else "M", "Courier Status": "Shipped" if i % 2 else "Cancelled",
                "Qty": "1", "Amount": str(10 + i), "ship-city": f"City, {i % 2}", "ship-state": "GOA" if i < 30 else "Kerala",
                "promotion-ids": ",".join(f"p{k}" for k in range(i % 6)),
            }
            writer.writerow([row[name] for name in SALES_COLUMNS])
    return str(path)


@pytest.fixture
def lines_source(source):
    with open(source, "a") as out:
        out.write(",".join(SALES_COLUMNS) + "\n1,2,3\n")
    return source


def test_winners(spark, lines_source, tmp_path):
    jobs.winners(spark, lines_source, str(tmp_path / "out"), files=1, threshold=10)
    (part,) = (tmp_path / "out").glob("part-*")
    lines = list(csv.reader(part.open()))
    assert lines[0] == ["state", "window_date", "most_bought_size", "frequency", "population_variance"]
    assert lines[1][:4] == ["GOA", "2022-04-02", "M", "3"]
    # GOA has 15 bought rows, so 5 days; Kerala has 5, so 10.
    assert [sum(row[0] == s for row in lines) for s in ("GOA", "KERALA")] == [9, 14]


def test_medians(spark, lines_source, tmp_path):
    jobs.medians(spark, lines_source, str(tmp_path / "out"))
    back = spark.read.option("header", True).csv(str(tmp_path / "out"))
    assert rows_of(back) == {("2022-04", "GOA", "2.0"), ("2022-04", "KERALA", "2.0")}


def test_percentages(spark, source, tmp_path):
    jobs.percentages(spark, source, str(tmp_path / "out"), files=1)
    # Of the 20 even records, 4, 10, 16, 22, 28 and 34 have four promotions. The averages are 25 and, from 30 on, 45:
    # 4, 10 and 34 are below.
    assert rows_of(spark.read.parquet(str(tmp_path / "out"))) == {("CITY, 0", 15.0)}


def test_percentiles(spark, source, tmp_path):
    tables = jobs.percentiles(spark, source, str(tmp_path / "out"), files=1)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.count() == 16
    row = back.where("SKU = 'sku0' and method = 'exact'").first()
    assert (row["order_count"], row["p80"], row["p80_order_count"]) == (5, pytest.approx(2.4), 1)
    row = back.where("SKU = 'sku0' and method = 'approx'").first()
    assert (row["order_count"], row["p80"], row["p80_order_count"]) == (5, 2.0, 3)
    assert tables["groups"].first() == (8, 5, 0)
    assert [r["percentile"] for r in tables["summary"].collect()] == ["P80", "P90"]
    assert tables["largest changes"].count() > 0


def test_percentiles_stop_at_a_malformed_line(spark, lines_source, tmp_path):
    with pytest.raises(Exception, match="MALFORMED"):
        jobs.percentiles(spark, lines_source, str(tmp_path / "out"))


def test_command_line(spark, source, tmp_path, capsys):
    jobs.main(["percentages", source, str(tmp_path / "out")])
    assert spark.read.parquet(str(tmp_path / "out")).count() == 1
    with pytest.raises(SystemExit):
        jobs.main(["unknown", source, "x"])
