from __future__ import annotations

import datetime as dt
import random
from collections import defaultdict
from fractions import Fraction
from statistics import pvariance

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F
from tests.conftest import day, rows_of

from orderlens.operators import windows
from orderlens.operators.checks import observed_profile
from orderlens.plans import bought_records, trailing_winners

SCHEMA = "state string, order_date date, size string, amount double"


def bought(spark, *rows):
    return spark.createDataFrame([(s, day(d) if d else None, z, a) for s, d, z, a in rows], SCHEMA)


def brute(rows, threshold=10_000, short=5, long=10):
    totals = defaultdict(int)
    for state, *_ in rows:
        if state:
            totals[state] += 1
    buckets = defaultdict(list)
    for state, date, size, amount in rows:
        if state and date and size:
            for ahead in range(1, (short if totals[state] > threshold else long) + 1):
                buckets[state, day(date) + dt.timedelta(ahead), size].append(Fraction(str(amount or 0)))
    best = {}
    for (state, date, size), amounts in buckets.items():
        rank = (-len(amounts), pvariance(amounts), size)
        if (state, date) not in best or rank < best[state, date]:
            best[state, date] = rank
    return [(s, d, size, -n, pytest.approx(float(v), rel=1e-12)) for (s, d), (n, v, size) in sorted(best.items())]


def same(actual, expected):
    return sorted(map(tuple, actual.collect())) == expected


def test_is_bought(spark):
    cases = [
        ("Shipped", "1", True), ("shipped - Returned to Seller", "2", True), ("SHIPPED", "-1", True),
        ("Shipped", "0", False), ("Shipped", "0.0", False), ("Shipped", "", False), ("Shipped", "x", False),
        ("Shipped", None, False), (None, "1", False), ("Cancelled", "1", False),
    ]
    df = spark.createDataFrame(cases, "status string, qty string, expected boolean")
    wrong = df.where(windows.is_bought(F.col("status"), F.col("qty")) != F.col("expected"))
    assert wrong.count() == 0
    assert df.where(windows.is_bought(F.col("status"), F.col("qty")).isNull()).count() == 0


def test_one_order_reaches_the_days_after_it(spark):
    winners = windows.trailing_window_winner(bought(spark, ("GOA", "2022-04-30", "M", 5.0))).collect()
    assert sorted(row["window_date"] for row in winners) == [
        dt.date(2022, 5, 1) + dt.timedelta(i) for i in range(10)
    ]
    assert {tuple(row)[2:] for row in winners} == {("M", 1, 0.0)}


def test_length_switches_above_the_threshold(spark):
    at = [("AT", "2022-01-01", "M", 1.0)] * 3
    above = [("ABOVE", "2022-01-01", "M", 1.0)] * 4
    winners = windows.trailing_window_winner(bought(spark, *at, *above), threshold=3)
    assert rows_of(winners.groupBy("state").count()) == {("AT", 10), ("ABOVE", 5)}


def test_rows_without_date_or_size_count_for_the_length_only(spark):
    rows = [("GOA", "2022-01-01", "M", 1.0), ("GOA", None, "M", 1.0), ("GOA", "2022-01-01", "", 1.0),
            ("GOA", "2022-01-01", None, 1.0), ("", "2022-01-01", "M", 1.0), (None, "2022-01-01", "M", 1.0)]
    winners = windows.trailing_window_winner(bought(spark, *rows), threshold=3)
    assert rows_of(winners.groupBy("state", "frequency").count()) == {("GOA", 1, 5)}


def test_ties(spark):
    lower_variance = [("A", "2022-01-01", "L", 1.0), ("A", "2022-01-01", "L", 9.0),
                      ("A", "2022-01-01", "S", 4.0), ("A", "2022-01-01", "S", 5.0)]
    lower_name = [("B", "2022-01-01", "S", 3.0), ("B", "2022-01-01", "L", 7.0)]
    missing_is_zero = [("C", "2022-01-01", "S", None), ("C", "2022-01-01", "S", 2.0),
                       ("C", "2022-01-01", "L", 5.0), ("C", "2022-01-01", "L", 6.0)]
    winners = windows.trailing_window_winner(bought(spark, *lower_variance, *lower_name, *missing_is_zero))
    found = rows_of(winners.where("window_date = '2022-01-05'").drop("window_date"))
    assert found == {("A", "S", 2, 0.25), ("B", "L", 1, 0.0), ("C", "L", 2, 0.25)}


def test_equal_variances_fall_to_the_name_despite_float_noise(spark):
    shifted = [("A", "2022-01-01", "B", x) for x in (0.1, 0.2, 0.3)]
    same_spread = [("A", "2022-01-01", "A", x) for x in (1000000.1, 1000000.2, 1000000.3)]
    winners = windows.trailing_window_winner(bought(spark, *shifted, *same_spread))
    assert {row["most_bought_size"] for row in winners.collect()} == {"A"}


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_against_brute_force(spark, seed):
    rng = random.Random(seed)
    hot = ["HOT"] * 6 + ["A", "B", "", "C"]
    rows = [
        (
            rng.choice(hot),
            None if rng.random() < 0.05 else str(dt.date(1969, 11, 1) + dt.timedelta(rng.randrange(130))),
            rng.choice(["S", "M", "L", ""]),
            None if rng.random() < 0.1 else rng.randrange(1, 40) / 4,
        )
        for _ in range(400)
    ]
    expected = brute(rows, threshold=60, short=3, long=40)
    assert same(windows.trailing_window_winner(bought(spark, *rows), threshold=60, short=3, long=40), expected)


def test_block_size_does_not_matter(spark):
    rng = random.Random(7)
    rows = [("A", str(dt.date(2022, 1, 1) + dt.timedelta(rng.randrange(50))), rng.choice("SML"), 1.0) for _ in range(90)]
    df = bought(spark, *rows)
    wide, narrow = (
        rows_of(windows.trailing_buckets(df, block_days=days)) for days in (365, 3)
    )
    assert wide == narrow


def test_given_totals_drop_unknown_states(spark):
    totals = spark.createDataFrame([("A", 99)], "state string, n bigint")
    rows = [("A", "2022-01-01", "M", 1.0), ("B", "2022-01-01", "M", 1.0)]
    winners = windows.trailing_window_winner(bought(spark, *rows), threshold=50, totals=totals)
    assert rows_of(winners.groupBy("state").count()) == {("A", 5)}


def test_a_busy_state_is_split_by_category(spark):
    """One state, 20 days, many categories: no task holds over twice the mean of the fanned-out rows."""
    rows = spark.range(0, 300_000, 1, 8).selectExpr(
        "'A' AS state", "date_add(date'2022-01-03', cast(id % 20 AS int)) AS order_date",
        "concat('c', id) AS size", "1.0D AS amount",
    )
    before = {name: spark.conf.get(name) for name in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        buckets = windows.trailing_buckets(rows, threshold=1)
        counts = [r["count"] for r in buckets.groupBy(F.spark_partition_id().alias("p")).count().collect()]
        assert sum(counts) == 300_000 * 5 and len(counts) == 16 and max(counts) <= 2 * sum(counts) / 16
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def test_window_quality(spark):
    totals = spark.createDataFrame([("A", 99)], "state string, n bigint")
    rows = [("A", "2022-01-01", "M", None), ("A", "2022-01-02", "M", 2.0), ("A", None, "M", 1.0), ("A", None, "", 1.0),
            ("B", "2022-01-01", "M", 1.0), ("B", None, "M", 1.0)]
    found = dict(rows_of(windows.window_quality(bought(spark, *rows), threshold=50, totals=totals)))
    assert found == {
        "BOUGHT_RECORDS": 2, "MISSING_AMOUNT": 1, "BUCKET_EMISSIONS": 10, "INVALID_DATE": 2, "STATE_COUNT_MISSING": 1,
    }


def record(state, date, size, amount, qty="1", status="Shipped"):
    return {"Status": status, "Qty": qty, "ship-state": state, "Date": date, "Size": size, "Amount": amount}


def test_from_text_records(raw):
    df = raw(
        record(" goa\t", " 01-01-22 ", " M ", "10.50"),
        record("GOA", "01-01-22", "m", "x"),
        record("GOA", "01-01-22", "M", ""),
        record("GOA", "13-01-22", "M", "1"),
        record("GOA", "01-01-22", "M", "1", qty="0"),
        record("GOA", "01-01-22", "M", "1", status="Pending"),
    )
    assert bought_records(df).count() == 4
    late = raw(record("GOA", "02-30-22", "M", "1"))
    assert [bought_records(late, lenient).first()["order_date"] for lenient in (True, False)] == [dt.date(2022, 2, 28), None]
    winner = trailing_winners(df, threshold=3).where("window_date = '2022-01-02'").first()
    assert tuple(winner)[2:] == ("M", 2, 27.5625)
    assert trailing_winners(df, threshold=3).count() == 5


def test_one_read_of_the_source(spark, tmp_path):
    path = str(tmp_path / "bought")
    bought(spark, ("A", "2022-01-01", "M", 1.0), ("B", "2022-01-02", "L", None), ("A", None, "M", 2.0)).write.parquet(path)
    winners = windows.trailing_window_winner(spark.read.parquet(path))
    winners.collect()
    plan = winners._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert plan.count("FileScan") == 1 and "ReusedExchange" in plan


@pytest.mark.parametrize("given", [False, True])
def test_counters_come_with_the_run(spark, given):
    rng = random.Random(9)
    rows = [(rng.choice(["A", "B", "C", ""]), rng.choice([None, "2022-01-01", "2022-02-03"]), rng.choice(["M", "L", "", None]),
             rng.choice([None, 1.5])) for _ in range(200)]
    df = bought(spark, *rows)
    totals = spark.createDataFrame([("A", 99), ("B", 1)], "state string, n bigint") if given else None
    counters = Observation()
    plain = rows_of(windows.trailing_window_winner(df, threshold=50, totals=totals))
    assert rows_of(windows.trailing_window_winner(df, threshold=50, totals=totals, counters=counters)) == plain
    expected = rows_of(windows.window_quality(df, threshold=50, totals=totals))
    assert rows_of(observed_profile(spark, counters)) == expected and len(expected) == 5


def test_events_take_in_and_out_what_the_days_hold(spark):
    """Every bucket against the sum over its days, with windows longer than a block and amounts far apart."""
    rng = random.Random(10)
    rows = [("A", str(dt.date(2022, 1, 1) + dt.timedelta(rng.randrange(60))), rng.choice("SML"), rng.choice([1e9, 0.01, -3.5, None])) for _ in range(150)]
    buckets = windows.trailing_buckets(bought(spark, *rows), long=40, block_days=7, scale=2)
    expected = defaultdict(lambda: [0, 0, 0])
    for state, date, size, amount in rows:
        cents = round((amount or 0) * 100)
        for ahead in range(1, 41):
            cell = expected[state, day(date) + dt.timedelta(ahead), size]
            cell[0], cell[1], cell[2] = cell[0] + 1, cell[1] + cents, cell[2] + cents * cents
    found = {(r.state, r.window_date, r.size): [r.n, int(r.s), int(r.ss)] for r in buckets.collect()}
    assert found == dict(expected)
