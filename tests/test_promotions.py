from __future__ import annotations

import pytest
from tests.conftest import day, rows_of

from orderlens.catalog import ENTRIES
from orderlens.operators import lookup
from orderlens.operators import promotions as promo
from orderlens.plans import promotion_percentages, promotion_records


def orders(spark, *rows):
    return spark.createDataFrame(
        [(o, day(d) if d else None, p) for o, d, p in rows], "order_id string, order_date date, promotion_ids string"
    )


def test_appearances(spark):
    df = orders(spark, ("1", "2022-01-01", "a, a,,b"), ("1", "2022-01-02", "a"), ("2", None, "a"),
                ("3", "2022-01-01", None), ("4", "2022-01-01", ",,"))
    found = [tuple(r) for r in promo.promotion_appearances(df).select("order_id", "promotion_id").collect()]
    assert sorted(found) == [("1", "a"), ("1", "a"), ("1", "b")]


def test_valid_promotions_need_two_days(spark):
    df = orders(spark, ("1", "2022-01-01", "a,b,c"), ("2", "2022-01-02", "a"), ("3", "2022-01-03", "b"))
    assert rows_of(promo.valid_promotions(promo.promotion_appearances(df))) == {
        ("b", day("2022-01-01"), day("2022-01-03"), 2)
    }


def test_counts_add_up_over_the_records_of_an_order(spark):
    df = orders(spark, ("1", "2022-01-01", "a,b"), ("1", "2022-01-05", "a, a"), ("2", "2022-01-05", "a,b"))
    appearances = promo.promotion_appearances(df)
    counts = promo.valid_promotion_counts(appearances, promo.valid_promotions(appearances))
    assert rows_of(counts) == {("1", 3)}
    assert rows_of(promo.valid_promotion_counts(appearances, promo.valid_promotions(appearances), 1)) == {
        ("1", 3), ("2", 2),
    }


def test_a_list_too_large_to_broadcast_filters_before_the_shuffle(spark, tmp_path):
    """Of 200,000 appearances 5 % are of valid promotions; with no room to broadcast, few others reach the join."""
    appearances = spark.range(200_000).selectExpr(
        "CAST(id % 9000 AS STRING) AS order_id", "date_add(date'2022-01-01', CAST(id % 7 AS INT)) AS order_date",
        "CASE WHEN id % 20 = 0 THEN concat('v', id % 500) ELSE concat('x', id) END AS promotion_id",
    )
    valid = promo.valid_promotions(appearances)
    plain = rows_of(promo.valid_promotion_counts(appearances, valid, 1))
    spark.conf.set(lookup.BROADCAST_SETTING, "0")
    try:
        with lookup.Workspace(spark, str(tmp_path)) as workspace:
            listed = workspace.lookup(valid.select("promotion_id"))
            passed = lookup.prefiltered(appearances, listed, "promotion_id", workspace)
            hits = passed.where("promotion_id LIKE 'v%'").count()
            assert (hits, listed.rows) == (10_000, 25)
            assert passed.count() - hits <= 190_000 * 0.05
            counts = promo.valid_promotion_counts(appearances, valid, 1, workspace=workspace)
            plan = counts._jdf.queryExecution().executedPlan().toString()
            assert "SortMergeJoin" in plan and plan.count("BroadcastHashJoin") == 1
            assert rows_of(counts) == plain
    finally:
        spark.conf.unset(lookup.BROADCAST_SETTING)


@pytest.mark.parametrize(("keys", "share"), [(50, 0.1), (20_000, 0.015)])
def test_share_of_other_keys_that_pass(spark, tmp_path, keys, share):
    with lookup.Workspace(spark, str(tmp_path)) as workspace:
        listed = workspace.lookup(spark.range(keys).selectExpr("concat('k', id) AS k"))
        others = spark.range(keys, keys + 100_000).selectExpr("concat('k', id) AS k")
        assert lookup.prefiltered(listed.table, listed, "k", workspace).count() == keys
        assert lookup.prefiltered(others, listed, "k", workspace).count() < share * 100_000


def test_amount_equal_to_the_average_is_not_below(spark):
    averages = promo.benchmark_averages(
        spark.createDataFrame([("A", 0.1)] * 3 + [("B", None), (None, 5.0)], "state string, amount double")
    )
    assert [row["state"] for row in averages.collect()] == ["A"]
    assert averages.first()["average"] == pytest.approx(0.1)
    df = spark.createDataFrame(
        [("A", 0.1), ("A", 0.09), ("A", None), ("B", 0.0), (None, 0.0)], "state string, amount double"
    )
    assert rows_of(promo.below_benchmark(df, averages)) == {
        ("A", 0.1, False), ("A", 0.09, True), ("A", None, True), ("B", 0.0, False), (None, 0.0, False),
    }


def record(order, city, state="GOA", amount="10", promotions="p,q,r", date="01-01-22", **more):
    base = {"Order ID": order, "ship-city": city, "ship-state": state, "Amount": amount, "promotion-ids": promotions,
            "Date": date, "Status": "Cancelled", "ship-service-level": "Standard", "Fulfilment": "Platform",
            "Courier Status": "Unshipped"}
    return {**base, **more}


BENCHMARK = {"Fulfilment": "Merchant ", "Courier Status": " SHIPPED", "Status": "Shipped", "promotions": "p,q,r"}


def test_percentages_from_text_records(raw):
    df = raw(
        # The benchmark of GOA is 20, and it stretches p, q and r over two days.
        record("m1", "X", amount="10", date="01-03-22", **BENCHMARK),
        record("m2", "X", amount="30", **BENCHMARK),
        # Panaji: below; equal to the average; missing amount counts as 0; too few promotions; no state benchmark.
        record("1", "panaji "),
        record("2", "Panaji", amount="20"),
        record("3", "PANAJI", amount=None),
        record("4", "PANAJI", promotions="p,q"),
        record("5", "PANAJI", state="SIKKIM"),
        # Two records of one order: neither has three promotions, the order has four.
        record("6", "Margao", promotions="p,q"),
        record("6", "Margao", promotions="p,r", amount="30"),
        # A blank order id gathers the records of all such; a null one drops out; a bad date adds no promotions.
        record(" ", "Vasco", promotions="p,q"),
        record("", "Vasco", promotions="r"),
        record(None, "Vasco"),
        record("8", "Mapusa", date="02-30-22"),
        # Not in the denominator.
        record("9", None),
        record("10", "Mapusa", **{"Status": "Shipped"}),
        record("11", "Mapusa", **{"ship-service-level": "Expedited"}),
        # Cancelled in any form.
        record("12", "Ponda", **{"Status": "Buyer CANCELLED it", "ship-service-level": " standard "}),
    )
    assert rows_of(promotion_percentages(df)) == {
        ("PANAJI", 40.0), ("MARGAO", 50.0), ("VASCO", 100.0), ("MAPUSA", 0.0), ("PONDA", 100.0),
    }


def test_malformed_can_fail(raw):
    bad = raw(record("1", "X", amount="ten"))
    assert promotion_records(bad).first()["amount"] is None
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        promotion_records(bad, malformed="fail").collect()


def test_catalog_counts_do_not_shuffle_appearances_by_promotion(spark):
    """The list of lasting promotions is measured, so it is broadcast; line items are not sorted for their orders."""
    counts = ENTRIES["order_promotion_counts"].build(spark, "/root/testdata/sf0.001")
    plan = counts._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(promotion_id" not in plan and "ShuffledHashJoin [l_orderkey" in plan
