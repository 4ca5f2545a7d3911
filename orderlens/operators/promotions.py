"""Promotions that last, and the share of records that meet a promotion and price condition."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlens.functions import moments
from orderlens.functions.text import distinct_tokens
from orderlens.operators.lookup import Workspace, lookup_join, prefiltered

MIN_ACTIVE_DAYS = 2
MIN_PROMOTIONS = 3


def promotion_appearances(
    records: DataFrame, order: str = "order_id", date: str = "order_date", promotions: str = "promotion_ids"
) -> DataFrame:
    """One row per dated record and promotion in its comma list; a list's blanks and repeats are dropped.

    Two records of one order that name the same promotion give two rows.
    """
    return records.where(F.col(date).isNotNull()).select(
        order, date, F.explode(distinct_tokens(F.col(promotions))).alias("promotion_id")
    )


def promotion_spans(appearances: DataFrame, date: str = "order_date") -> DataFrame:
    first, last = F.min(date), F.max(date)
    return appearances.groupBy("promotion_id").agg(
        first.alias("first_appearance"),
        last.alias("last_appearance"),
        F.datediff(last, first).alias("active_days"),
    )


def valid_promotions(
    appearances: DataFrame, min_days: int = MIN_ACTIVE_DAYS, date: str = "order_date"
) -> DataFrame:
    """Promotions whose last appearance is at least ``min_days`` days after their first."""
    return promotion_spans(appearances, date).where(F.col("active_days") >= min_days)


def valid_promotion_counts(
    appearances: DataFrame,
    valid: DataFrame,
    min_count: int = MIN_PROMOTIONS,
    order: str = "order_id",
    workspace: Workspace | None = None,
) -> DataFrame:
    """Appearances of valid promotions per order, for orders with at least ``min_count``.

    If the valid list is broadcast, the appearances are never shuffled one by one: each task counts its own per order
    first. If it was measured and is too big, a filter of its ids, of bounded size, keeps most appearances of other
    promotions from being shuffled, and adaptive execution splits promotions that are everywhere.
    """
    listed = valid.select("promotion_id")
    if workspace is not None:
        listed = workspace.lookup(listed, "valid-promotions")
        if not listed.fits():
            appearances = prefiltered(appearances, listed, "promotion_id", workspace)
    return (
        lookup_join(appearances, listed, "promotion_id")
        .groupBy(order)
        .agg(F.count(F.lit(1)).alias("valid_promotion_count"))
        .where(F.col("valid_promotion_count") >= min_count)
    )


def is_merchant_shipped(fulfilment: Column, courier_status: Column) -> Column:
    """Of lower-case texts; never null."""
    return F.coalesce((fulfilment == "merchant") & (courier_status == "shipped"), F.lit(False))


def is_cancelled_standard(status: Column, service_level: Column) -> Column:
    """Of lower-case texts; never null."""
    return F.coalesce((service_level == "standard") & status.contains("cancelled"), F.lit(False))


def benchmark_averages(
    records: DataFrame, key: str = "state", amount: str = "amount", scale: int = moments.DEFAULT_SCALE
) -> DataFrame:
    """Average of the non-null amounts per key, beside the exact ``n`` and ``s`` (in units) it comes from."""
    u = moments.units(F.col(amount), scale)
    return (
        records.where(F.col(key).isNotNull() & F.col(amount).isNotNull())
        .groupBy(key)
        .agg(F.count(u).alias("n"), moments.sum_units(u).alias("s"))
        .select(key, "n", "s", (F.col("s").cast("double") / F.col("n") / float(10**scale)).alias("average"))
    )


def below_benchmark(
    records: DataFrame,
    averages: DataFrame,
    key: str = "state",
    amount: str = "amount",
    scale: int = moments.DEFAULT_SCALE,
    workspace: Workspace | None = None,
) -> DataFrame:
    """Add ``below_benchmark``: the amount, 0 if null, is less than its key's average. False without an average.

    ``amount < s/n`` is tested as ``amount * n < s`` on whole numbers, so an amount equal to it is never below.
    """
    u = F.coalesce(moments.units(F.col(amount), scale), F.lit(0).cast(moments.UNITS))
    table = averages.select(key, F.col("n").alias("_n"), F.col("s").alias("_s"))
    return (
        lookup_join(records, table, key, "left", workspace)
        .withColumn("below_benchmark", F.coalesce(u * F.col("_n").cast("decimal(20,0)") < F.col("_s"), F.lit(False)))
        .drop("_n", "_s")
    )


def qualifying_share(
    records: DataFrame,
    counts: DataFrame,
    averages: DataFrame,
    group: str = "city",
    key: str = "state",
    order: str = "order_id",
    amount: str = "amount",
    min_count: int = MIN_PROMOTIONS,
    scale: int = moments.DEFAULT_SCALE,
    workspace: Workspace | None = None,
) -> DataFrame:
    """Per group: all records, and those below their benchmark whose order has ``min_count`` valid promotions.

    The records are counted per (order, group) before they meet ``counts``. Those rows no longer grow with an order
    id that many records share (blank ids do that), so the join on the order has no hot key.
    """
    per_order = (
        below_benchmark(records.where(F.col(group).isNotNull()), averages, key, amount, scale, workspace)
        .groupBy(order, group)
        .agg(F.count(F.lit(1)).alias("records"), F.count_if("below_benchmark").alias("below"))
    )
    enough = F.coalesce(F.col("valid_promotion_count") >= min_count, F.lit(False))
    return (
        per_order.join(counts.select(order, "valid_promotion_count"), order, "left")
        .groupBy(group)
        .agg(
            F.sum("records").alias("total_records"),
            F.sum(F.when(enough, F.col("below")).otherwise(0)).alias("qualifying_records"),
        )
    )


def below_benchmark_percentage(
    records: DataFrame,
    counts: DataFrame,
    averages: DataFrame,
    group: str = "city",
    key: str = "state",
    order: str = "order_id",
    amount: str = "amount",
    min_count: int = MIN_PROMOTIONS,
    scale: int = moments.DEFAULT_SCALE,
    workspace: Workspace | None = None,
) -> DataFrame:
    """Percentage of each group's records that qualify. See ``qualifying_share``."""
    share = qualifying_share(records, counts, averages, group, key, order, amount, min_count, scale, workspace)
    ratio = F.col("qualifying_records").cast("double") / F.col("total_records").cast("double")
    return share.select(group, (ratio * 100.0).alias("percentage"))
