"""The analyses give the same rows without a workspace, with one, and when lookups are too big to broadcast."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F
from tests.conftest import rows_of

from orderlens import plans
from orderlens.operators import lookup
from orderlens.operators.variety import median_variety

HOT = 3


@pytest.fixture(scope="module")
def records(spark):
    """A third of all rows share one state, order id, style, SKU, size and promotion."""
    rng = random.Random(11)

    def pick(prefix, n):
        return f"{prefix}hot" if rng.randrange(HOT) == 0 else f"{prefix}{rng.randrange(n)}"

    rows = []
    for _ in range(900):
        shipped = rng.random() < 0.5
        promotions = ", ".join(pick("p", 12) for _ in range(rng.randrange(6)))
        day = f"{rng.randrange(1, 4):02d}-{rng.randrange(1, 28):02d}-22"
        rows.append(
            (
                rng.choice(["", " ", "o1"]) if rng.randrange(HOT) == 0 else f"o{rng.randrange(300)}",
                day,
                "Shipped" if shipped else "Cancelled",
                rng.choice(["Merchant", "Platform"]),
                rng.choice(["Standard", "Expedited"]),
                pick("style", 9),
                pick("sku", 30),
                rng.choice(["XXL", "M", "M", "S"]),
                "Shipped" if shipped else "Cancelled",
                "1",
                str(rng.randrange(10, 99)) if rng.random() < 0.9 else None,
                pick("city", 5),
                pick("state", 6) if rng.random() < 0.95 else None,
                promotions,
            )
        )
    names = ["Order ID", "Date", "Status", "Fulfilment", "ship-service-level", "Style", "SKU", "Size",
             "Courier Status", "Qty", "Amount", "ship-city", "ship-state", "promotion-ids"]
    return spark.createDataFrame(rows, ", ".join(f"`{n}` string" for n in names)).repartition(4)


def medians_of_given_styles(raw, workspace):
    rows = plans.variety_records(raw)
    return median_variety(rows, styles=rows.where("sku = 'SKU1'").select("style"), workspace=workspace)


def percentile_rows(raw, workspace):
    results = plans.percentile_statistics(plans.percentile_records(raw), workspace=workspace)
    rounded = [F.round(c, 6) if t == "double" else F.col(c) for c, t in results.comparison.dtypes]
    return results.comparison.select(*rounded)


ANALYSES = {
    "winners": lambda raw, kept: plans.trailing_winners(raw, threshold=60, workspace=kept),
    "medians": lambda raw, kept: plans.variety_medians(raw, workspace=kept),
    "medians of given styles": medians_of_given_styles,
    "quality": lambda raw, kept: plans.variety_quality(raw, workspace=kept),
    "percentages": lambda raw, kept: plans.promotion_percentages(raw, workspace=kept),
    "percentiles": percentile_rows,
}


@pytest.mark.parametrize("name", ANALYSES)
def test_same_rows(spark, records, tmp_path, name):
    run = ANALYSES[name]
    expected = rows_of(run(records, None))
    assert expected
    for limit in (str(lookup.BROADCAST_BYTES), "-1"):
        spark.conf.set(lookup.BROADCAST_SETTING, limit)
        try:
            with lookup.Workspace(spark, str(tmp_path)) as workspace:
                assert rows_of(run(records, workspace)) == expected
        finally:
            spark.conf.unset(lookup.BROADCAST_SETTING)
        assert not list(tmp_path.iterdir())


def test_percentages_read_the_records_three_times(spark, records, tmp_path):
    """Spans, orders' promotions, and amounts; the promotion lists are not copied."""
    with lookup.Workspace(spark, str(tmp_path)) as workspace:
        kept = plans.promotion_percentages(records, workspace=workspace)
        plan = kept._jdf.queryExecution().optimizedPlan().toString()
        # The spans are in the staged list of valid promotions and the amounts in their table: one read is left.
        assert plan.count("LogicalRDD") + plan.count("LocalRelation") <= 1
        (amounts,) = [p for p in workspace.paths if "amounts" in p]
        assert "promotion_ids" not in spark.read.parquet(amounts).columns


def order_share(rows):
    """``promotion_percentages`` row by row."""
    spans, tokens = {}, []
    for r in rows:
        names = {t.strip(" ") for t in (r["promotion-ids"] or "").split(",")} - {""}
        tokens.append(names)
        month, day, _ = r["Date"].split("-")
        for t in names:
            spans.setdefault(t, []).append(int(month) * 31 + int(day))
    valid = {t for t, days in spans.items() if max(days) - min(days) >= 2}
    counts, sums = {}, {}
    for r, names in zip(rows, tokens, strict=True):
        order = r["Order ID"].strip(" ")
        counts[order] = counts.get(order, 0) + len(names & valid)
        if r["Fulfilment"] == "Merchant" and r["Courier Status"] == "Shipped" and r["ship-state"] and r["Amount"]:
            sums.setdefault(r["ship-state"], []).append(int(r["Amount"]))
    total, good = {}, {}
    for r in rows:
        if r["ship-service-level"] == "Standard" and r["Status"] == "Cancelled":
            city = r["ship-city"].upper()
            total[city] = total.get(city, 0) + 1
            amounts = sums.get(r["ship-state"], [])
            below = int(r["Amount"] or 0) * len(amounts) < sum(amounts)
            good[city] = good.get(city, 0) + (counts[r["Order ID"].strip(" ")] >= 3 and below)
    return {(city, good[city] / n * 100) for city, n in total.items()}


def test_percentages_against_brute_force(records):
    assert rows_of(plans.promotion_percentages(records)) == order_share(records.collect())
