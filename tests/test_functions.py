from __future__ import annotations

import datetime as dt
import math
import statistics
from decimal import Decimal
from fractions import Fraction

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from orderlens.functions import moments, parsing, text


def column(spark, values, kind, expression):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [row[0] for row in df.orderBy("i").select(expression(F.col("v"))).collect()]


SIZES = {
    "XS": 1, "S": 2, "m": 3, "L": 4, "XL": 5, "XXL": 6, "XXXL": 7, " x x l ": 6, "xxxxxl": 9,
    "2XL": 6, "3XL": 7, "9xl": 13, "20XL": 24, "10XL": None, "12XL": None, "1XL": None, "0XL": None,
    "Free": None, "": None, None: None, "XLS": None, "2XXL": None, "L L": None,
    "99999999999999999999XL": None, "2147483647XL": None,
}


def test_size_rank(spark):
    assert column(spark, list(SIZES), "string", text.size_rank) == list(SIZES.values())


def test_strip_takes_control_characters_but_not_wide_blanks(spark):
    assert column(spark, ["\t a b \r\n", "\x00x\x1f", " x", "", None], "string", text.strip) == [
        "a b", "x", " x", "", None,
    ]


def test_squeeze_upper(spark):
    assert column(spark, [" tamil \t nadu ", "goa"], "string", text.squeeze_upper) == ["TAMIL NADU", "GOA"]


def test_has_text_is_never_null(spark):
    assert column(spark, ["a", "", None, " "], "string", text.has_text) == [True, False, False, True]


def test_tokens(spark):
    lists = ["a,b,a", " a , ,a,,b ", ",,", "", None, "one two , three"]
    kept = [["a", "b", "a"], ["a", "a", "b"], [], [], [], ["one two", "three"]]
    assert column(spark, lists, "string", text.tokens) == kept
    assert column(spark, lists, "string", text.token_count) == [3, 3, 0, 0, 0, 2]
    assert column(spark, lists, "string", text.distinct_tokens)[:2] == [["a", "b"], ["a", "b"]]


def test_dates_are_strict_and_tolerant(spark):
    values = ["04-30-22", "02-30-22", "2022-04-30", "x", "", None, "4-3-22", "12-31-99"]
    expected = [dt.date(2022, 4, 30), None, None, None, None, None, None, dt.date(2099, 12, 31)]
    assert column(spark, values, "string", parsing.parse_date) == expected


def test_malformed_fail_aborts(spark):
    with pytest.raises(Exception, match="CAST_INVALID_INPUT|CANNOT_PARSE"):
        column(spark, ["x"], "string", lambda c: parsing.parse_double(c, "fail"))
    with pytest.raises(Exception, match="CAST_INVALID_INPUT|CANNOT_PARSE"):
        column(spark, ["02-30-22"], "string", lambda c: parsing.parse_date(c, "fail"))
    with pytest.raises(ValueError):
        parsing.parse_double(F.lit("1"), "maybe")


def test_month_matches_date_format(spark):
    values = [dt.date(2022, 4, 30), dt.date(1969, 1, 1), dt.date(1, 1, 1), dt.date(9999, 12, 31), None]
    assert column(spark, values, "date", parsing.month_of) == column(
        spark, values, "date", lambda c: F.date_format(c, "yyyy-MM")
    )


def test_units(spark):
    values = [647.62, 0.1, -3.0, math.nan, math.inf, None, 899999999999.99]
    assert column(spark, values, "double", lambda c: moments.units(c, 2)) == [
        Decimal(64762), Decimal(10), Decimal(-300), None, None, None, Decimal(89999999999999),
    ]
    assert column(spark, ["647.62", "1d", "x", ""], "string", lambda c: moments.units(c, 2)) == [
        Decimal(64762), Decimal(100), None, None,
    ]


def moments_of(spark, amounts):
    df = spark.createDataFrame([(float(a),) for a in amounts], "a double").select(moments.units(F.col("a")).alias("u"))
    u, n, s, ss = (F.col(c) for c in ("u", "n", "s", "ss"))
    sums = df.agg(F.count(u).alias("n"), moments.sum_units(u).alias("s"), moments.sum_squares(u).alias("ss"))
    spread = moments.spread(n, s, ss)
    return sums.select(
        moments.variance(n, s, ss).alias("v"),
        moments.stddev(n, s, ss).alias("sd"),
        spread.alias("w"),
    ).first()


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.integers(-10**8, 10**8).map(lambda i: i / 100), min_size=1, max_size=30))
def test_variance_is_the_population_variance(spark, amounts):
    exact = float(statistics.pvariance([Decimal(str(a)) for a in amounts]))
    v, sd, w = moments_of(spark, amounts)
    assert v == pytest.approx(exact, rel=1e-12, abs=1e-12)
    units, n = [int(Decimal(str(a)) * 10**4) for a in amounts], len(amounts)
    assert n * w["lead"] + w["rest"] == n * sum(u * u for u in units) - sum(units) ** 2
    assert sd == pytest.approx(math.sqrt(exact), rel=1e-12, abs=1e-9)


def test_equal_amounts_have_no_variance_at_all(spark):
    assert tuple(moments_of(spark, [999999.99] * 7)) == (0.0, 0.0, (0, 0))
    assert tuple(moments_of(spark, []))[:2] == (None, None)


@pytest.mark.parametrize(
    ("amounts", "scale"),
    [([1e14, 10.0], 4), ([2e14, 5e14], 4), ([3e-5, 1e-5], 6), ([1e12 + i * 1e9 for i in range(4000)], 4)],
    ids=["large", "larger", "fine", "many"],
)
def test_no_amount_is_dropped(spark, amounts, scale):
    exact = [Fraction(a) for a in amounts]
    df = spark.createDataFrame([(a,) for a in amounts], "a double").select(moments.units(F.col("a"), scale).alias("u"))
    n, s, ss = (F.col(c) for c in ("n", "s", "ss"))
    u = F.col("u")
    sums = df.agg(F.count(u).alias("n"), moments.sum_units(u).alias("s"), moments.sum_squares(u).alias("ss"))
    row = sums.select("n", "s", moments.variance(n, s, ss, scale).alias("v"), moments.spread(n, s, ss)).first()
    mean = sum(exact) / len(exact)
    assert row["n"] == len(amounts)
    assert float(Fraction(row["s"]) / 10**scale / len(exact)) == pytest.approx(float(mean), rel=1e-12)
    assert row["v"] == pytest.approx(float(sum((x - mean) ** 2 for x in exact) / len(exact)), rel=1e-9)


@pytest.mark.parametrize("amounts", [[1e30], [9e18, 9e18]])
def test_amounts_out_of_range_end_the_job(spark, amounts):
    df = spark.createDataFrame([(a,) for a in amounts], "a double").select(moments.units(F.col("a")).alias("u"))
    with pytest.raises(Exception, match="(?i)out of range|overflow|NUMERIC_VALUE_OUT_OF_RANGE"):
        df.agg(moments.sum_squares(F.col("u"))).collect()


def test_lenient_dates(spark):
    values = ["02-30-22", "02-31-24", "04-31-22", "04-30-22", "13-01-22", "02-32-22", "2-30-22", "02-00-22", "", None]
    found = column(spark, values, "string", parsing.parse_date_leniently)
    assert found == [dt.date(2022, 2, 28), dt.date(2024, 2, 29), dt.date(2022, 4, 30), dt.date(2022, 4, 30), *[None] * 6]


def test_separators_are_plain_text(spark):
    assert column(spark, ["a|b| c", " |", None], "string", lambda c: text.tokens(c, "|")) == [["a", "b", "c"], [], []]
