from __future__ import annotations

import pytest
from tests.conftest import rows_of

from orderlens.operators import checks
from orderlens.sources import readers, writers
from orderlens.sources.sample import sales
from orderlens.sources.schema import SALES_COLUMNS

HEADER = ",".join(SALES_COLUMNS)


def line(index, category="c", width=24):
    fields = [index, *[str(i) for i in range(1, width)]]
    if width > 9:
        fields[9] = category
    return ",".join(fields)


@pytest.fixture
def csv(tmp_path):
    def write(*lines):
        path = tmp_path / "sales.csv"
        path.write_text("\n".join(lines) + "\n")
        return str(path)

    return write


def test_permissive_pads_and_cuts(spark, csv):
    df = readers.read_sales(spark, csv(HEADER, line("a"), line("b", width=3), line("c", width=26)))
    assert df.columns == list(SALES_COLUMNS)
    found = {r["index"]: (r["Date"], r["SKU"], r["Unnamed: 22"]) for r in df.collect()}
    assert found == {"a": ("2", "8", "23"), "b": ("2", None, None), "c": ("2", "8", "23")}


def test_strict_fails_on_another_width_whatever_is_selected(spark, csv):
    assert readers.read_sales_strict(spark, csv(HEADER, line("a"))).count() == 1
    bad = readers.read_sales_strict(spark, csv(HEADER, line("a"), line("b", width=3)))
    with pytest.raises(Exception, match="MALFORMED"):
        bad.select("SKU").collect()


LINES = (
    HEADER, line("a", '"x, y"'), line("b", '"say ""hi"", twice"'), line("c", width=3), line("d", width=25),
    "\tINDEX " + HEADER[5:], line("e\t", "\tz\t"), '"index"' + HEADER[5:],
)


def test_rows_of_the_right_width(spark, csv):
    df = readers.read_sales_rows(spark, csv(*LINES))
    assert df.columns == list(SALES_COLUMNS)
    assert rows_of(df.select("index", "Category")) == {("a", "x, y"), ("b", 'say "hi", twice'), ("e\t", "\tz\t")}


def test_rows_keep_doubled_quotes_on_request(spark, csv):
    """Commas and backslashes in quotes are safe, one outer quote goes, and bare quotes stay single."""
    fields = {
        "a": ('"12"" wide, red"', '12"" wide, red'), "b": ('"abc\\"', "abc\\"), "c": ('"a ""b"" c"', 'a ""b"" c'),
        "d": (' "x" ', "x"), "e": ('5" pipe, 6"', '5" pipe, 6'), "f": ("", ""), "g": ('""', ""),
    }
    lines = [line(name, given) for name, (given, _) in fields.items()]
    df = readers.read_sales_rows(spark, csv(HEADER, *lines, line("w", width=23), line("v", width=25)), unescape_quotes=False)
    assert df.columns == list(SALES_COLUMNS)
    assert rows_of(df.select("index", "Category")) == {(name, kept) for name, (_, kept) in fields.items()}
    quality = readers.line_quality(readers.read_sales_lines(spark, csv(*LINES), unescape_quotes=False))
    assert dict(rows_of(quality)) == {"BAD_CSV_ROWS": 2, "HEADER_ROWS": 3}


def test_kept_quotes_are_cut_once_and_however_long(spark, csv):
    """Long quoted fields, and lines whose first quote has no partner: what precedes it is one field."""

    def line(start: str) -> str:
        return start + ",x" * 22

    long = "y," * 50_000 + "y"
    path = csv(line(f'a,"{long}"'), line('"b,c'), line('e,,f"g'), "h")
    df = readers.read_sales_rows(spark, path, unescape_quotes=False).select("index", "`Order ID`")
    assert rows_of(df) == {("a", long), ("b", "c")}
    corrupt = readers.read_sales_lines(spark, path, unescape_quotes=False).where("_corrupt is not null")
    assert rows_of(corrupt.select("_corrupt")) == {(line('e,,f"g'),), ("h",)}
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("split(value") == 2  # at commas alone, or at quotes


def test_orders_meet_customers_before_line_items(spark):
    plan = sales(spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString().splitlines()
    depth = [len(line) - len(line.lstrip(" :+-")) for line in plan]
    at = next(i for i, line in enumerate(plan) if "Join Inner" in line and "o_custkey" in line)
    end = next((i for i in range(at + 1, len(plan)) if depth[i] <= depth[at]), len(plan))
    assert not any("l_orderkey" in line for line in plan[at:end])


def test_line_quality(spark, csv):
    found = dict(rows_of(readers.line_quality(readers.read_sales_lines(spark, csv(*LINES)))))
    assert found == {"BAD_CSV_ROWS": 2, "HEADER_ROWS": 3}


def test_results_round_trip(spark, tmp_path):
    path = str(tmp_path / "out")
    df = spark.range(100).withColumnRenamed("id", "n")
    writers.write_results(df, path)
    writers.write_results(df, path, files=1)
    assert len(list((tmp_path / "out").glob("part-*"))) == 1
    assert readers.read_results(spark, path).count() == 100


def test_methods_round_trip(spark, tmp_path):
    path = str(tmp_path / "out")
    a = spark.createDataFrame([("k", 1.0)], "SKU string, p80 double")
    b = spark.createDataFrame([(2.0, "k"), (3.0, "l")], "p80 double, SKU string")
    writers.write_methods(a, b, path)
    back = readers.read_results(spark, path)
    assert rows_of(back) == {("k", 1.0, "approx"), ("k", 2.0, "exact"), ("l", 3.0, "exact")}
    assert rows_of(checks.rows_per_method(back)) == {("approx", 1), ("exact", 2)}
    assert checks.assert_unique_key(back, ["SKU", "method"], 3) == 3


@pytest.mark.parametrize("files", [None, 1, 3])
def test_report_is_sorted_and_quoted(spark, tmp_path, files):
    df = spark.createDataFrame([(f"s{i % 7}", i, 'a "b", c') for i in range(50)], "state string, n int, t string")
    writers.write_report(df.repartition(4), str(tmp_path / "out"), ["state", "n"], files)
    parts = sorted((tmp_path / "out").glob("part-*"))
    if files:
        assert len(parts) <= files
    keys = [tuple(row.split(",")[:2]) for part in parts for row in part.read_text().splitlines()[1:]]
    assert [(s, int(n)) for s, n in keys] == sorted((f"s{i % 7}", i) for i in range(50))
    back = spark.read.option("header", True).csv(str(tmp_path / "out"))
    assert back.columns == ["state", "n", "t"] and {r["t"] for r in back.collect()} == {'a "b", c'}


def test_unique_key(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), (None, 2)], "k string, v int")
    assert checks.key_profile(df, ["k", "v"]).first() == (3, 2)
    with pytest.raises(ValueError, match="share 2 keys"):
        checks.assert_unique_key(df, ["k", "v"])
    with pytest.raises(ValueError, match="expected 4"):
        checks.assert_unique_key(df, ["k", "v"], 4)
    assert checks.assert_unique_key(df.distinct(), ["k", "v"]) == 2


def test_quality_profile_and_range(spark):
    df = spark.createDataFrame([(1,), (None,), (5,)], "v int")
    rules = {"is null": df["v"].isNull(), "big": df["v"] > 3, "sum of v": df["v"]}
    assert dict(rows_of(checks.quality_profile(df, rules))) == {"is null": 1, "big": 1, "sum of v": 6}
    assert dict(rows_of(checks.quality_profile(df.limit(0), rules))) == {"is null": 0, "big": 0, "sum of v": 0}
    assert checks.value_range(df, "v").first() == (1, 5)
