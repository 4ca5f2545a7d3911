"""The joins between records and the small tables made from them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlens.catalog import base
from orderlens.catalog.base import Entry, with_
from orderlens.operators import comparison as cmp
from orderlens.operators import percentiles as pct
from orderlens.operators import promotions as promo
from orderlens.operators.lookup import lookup_join
from orderlens.operators.variety import qualifying_styles
from orderlens.operators.windows import key_counts
from orderlens.plans import workloads
from orderlens.sources.sample import sales


def state_count_lookup(spark: SparkSession, folder: str) -> DataFrame:
    """Bought rows with their state's total; only states above the threshold are in the table."""
    rows = base.bought(spark, folder)
    busy = key_counts(rows).where(F.col("n") > base.TEST_THRESHOLD)
    return lookup_join(rows.select("order_id", "state", "size"), busy, "state")


def states_without_count(spark: SparkSession, folder: str) -> DataFrame:
    """Bought rows whose state the table lacks, counted."""
    rows = base.bought(spark, folder)
    busy = key_counts(rows).where(F.col("n") > base.TEST_THRESHOLD)
    missed = lookup_join(rows.select("state"), busy, "state", "left_anti")
    return missed.groupBy("state").agg(F.count(F.lit(1)).alias("missed_rows"))


def valid_style_rows(spark: SparkSession, folder: str) -> DataFrame:
    rows = sales(spark, folder)
    styles = qualifying_styles(rows)
    return lookup_join(rows.select("order_id", "style", "sku", "size"), styles, "style", "left_semi")


def order_promotion_counts(spark: SparkSession, folder: str) -> DataFrame:
    appearances = promo.promotion_appearances(sales(spark, folder))
    return promo.valid_promotion_counts(
        appearances, promo.valid_promotions(appearances), workspace=base.workspace(spark)
    )


def record_promotion_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Cancelled standard records per order and city, beside the order's valid promotions (0 without any)."""
    rows = base.lowered(spark, folder)
    per_order = (
        rows.where("cancelled_standard")
        .groupBy("order_id", "city")
        .agg(F.count(F.lit(1)).alias("records"))
    )
    count = F.coalesce("valid_promotion_count", F.lit(0)).alias("valid_promotion_count")
    joined = per_order.join(order_promotion_counts(spark, folder), "order_id", "left")
    return joined.select("order_id", "city", "records", count)


def merchant_averages(rows: DataFrame) -> DataFrame:
    return promo.benchmark_averages(rows.where("merchant_shipped"))


def below_benchmark_flags(spark: SparkSession, folder: str) -> DataFrame:
    """Every cancelled standard record against its state's average; odd regions' records have no state."""
    rows = base.lowered(spark, folder)
    checked = rows.where("cancelled_standard").withColumn(
        "state", F.when(~F.col("city").rlike("[13]$"), F.col("state"))
    )
    flagged = promo.below_benchmark(checked, merchant_averages(rows))
    return flagged.select("order_id", "city", "state", "amount", "below_benchmark")


def qualifying_share(spark: SparkSession, folder: str) -> DataFrame:
    rows, workspace = base.lowered(spark, folder), base.workspace(spark)
    appearances = promo.promotion_appearances(rows)
    counts = promo.valid_promotion_counts(appearances, promo.valid_promotions(appearances), workspace=workspace)
    averages = merchant_averages(rows)
    return promo.qualifying_share(rows.where("cancelled_standard"), counts, averages, workspace=workspace)


def threshold_membership(spark: SparkSession, folder: str) -> DataFrame:
    """Each group's values with their rows and whether they reach the exact thresholds. Two styles have no month."""
    rows = base.prepared(spark, folder).withColumn(
        "year_month", F.when(~F.col("style").isin("Brand#1", "Brand#2"), F.col("year_month"))
    )
    profile = pct.value_profile(rows, base.GROUP)
    levels = pct.profile_thresholds(profile, base.GROUP)
    return profile.join(levels, list(base.GROUP)).select(
        *base.GROUP,
        "promotion_count",
        "n",
        (F.col("promotion_count") >= F.col("p80")).alias("reaches_p80"),
        (F.col("promotion_count") >= F.col("p90")).alias("reaches_p90"),
    )


def outcome(spark: SparkSession, folder: str) -> workloads.PercentileResults:
    return workloads.percentile_statistics(base.prepared(spark, folder), base.GROUP, amount="amount")


def results(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    found = outcome(spark, folder)
    return found.approx, found.exact


ROUNDED = ("approx_threshold", "exact_threshold", "approx_stddev", "exact_stddev", "threshold_diff", "stddev_diff")


def rounded(df: DataFrame, names: tuple[str, ...], digits: int = 4) -> DataFrame:
    return df.withColumns({name: F.round(name, digits) for name in names})


def rounded_sql(source: str = "comparison", digits: int = 4) -> str:
    return "SELECT * REPLACE (" + ", ".join(f"round({n}, {digits}) AS {n}" for n in ROUNDED) + f") FROM {source}"


def method_comparison(spark: SparkSession, folder: str) -> DataFrame:
    approx, exact = results(spark, folder)
    return rounded(cmp.compare_methods(approx, exact, "p80", base.GROUP), ROUNDED)


def changed_groups(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(cmp.changed_groups(outcome(spark, folder).comparison), ROUNDED)


def top_changes(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(cmp.top_changes(outcome(spark, folder).comparison, base.GROUP), ROUNDED)


def comparison_summary(spark: SparkSession, folder: str) -> DataFrame:
    summary = cmp.summarize_comparison(outcome(spark, folder).comparison)
    return summary.withColumn("mean_threshold_diff", F.round("mean_threshold_diff", 6))


PROMOTIONS = (base.APPEARANCES_SQL, base.VALID_SQL, base.ORDER_COUNTS_SQL)
METHODS = (
    base.PREPARED_SQL,
    base.thresholds_sql("a", "quantile_disc"),
    base.thresholds_sql("e", "quantile_cont"),
    base.statistics_sql("approx", "a"),
    base.statistics_sql("exact", "e"),
    base.comparison_sql(),
)
BUSY_SQL = f"busy AS (SELECT state, total AS n FROM counts WHERE total > {base.TEST_THRESHOLD})"

ENTRIES = {
    "state_count_lookup": Entry(
        state_count_lookup,
        with_(
            base.BOUGHT_SQL,
            base.COUNTS_SQL,
            BUSY_SQL,
            select="""SELECT order_id, state, size, n FROM sales JOIN busy USING (state)
WHERE lower(status) LIKE '%shipped%' AND qty <> 0""",
        ),
    ),
    "states_without_count": Entry(
        states_without_count,
        with_(
            base.BOUGHT_SQL,
            base.COUNTS_SQL,
            BUSY_SQL,
            select="SELECT state, count(*) AS missed_rows FROM bought ANTI JOIN busy USING (state) GROUP BY state",
        ),
    ),
    "valid_style_rows": Entry(
        valid_style_rows,
        with_(
            select="""SELECT order_id, style, sku, size FROM sales
WHERE style IN (SELECT style FROM sales WHERE size IN ('XXL', '3XL'))"""
        ),
    ),
    "order_promotion_counts": Entry(
        order_promotion_counts, with_(*PROMOTIONS, select="SELECT * FROM order_counts")
    ),
    "record_promotion_counts": Entry(
        record_promotion_counts,
        with_(
            *PROMOTIONS,
            select="""SELECT order_id, city, count(*) AS records,
  coalesce(any_value(valid_promotion_count), 0) AS valid_promotion_count
FROM sales LEFT JOIN order_counts USING (order_id)
WHERE service_level = 'Standard' AND status = 'Cancelled' GROUP BY order_id, city""",
        ),
    ),
    "below_benchmark_flags": Entry(
        below_benchmark_flags,
        with_(
            base.AVERAGES_SQL,
            """checked AS (SELECT order_id, city, amount,
    CASE WHEN city LIKE '%1' OR city LIKE '%3' THEN NULL ELSE state END AS state
  FROM sales WHERE service_level = 'Standard' AND status = 'Cancelled')""",
            select="""SELECT order_id, city, checked.state AS state, amount,
  coalesce(coalesce(amount, 0) < average, false) AS below_benchmark
FROM checked LEFT JOIN averages ON averages.state = checked.state""",
        ),
    ),
    "qualifying_share": Entry(
        qualifying_share, with_(*PROMOTIONS, base.AVERAGES_SQL, base.SHARE_SQL, select="SELECT * FROM share")
    ),
    "threshold_membership": Entry(
        threshold_membership,
        with_(
            base.PREPARED_SQL.replace("prepared AS", "every AS"),
            "prepared AS (SELECT * FROM every WHERE style NOT IN ('Brand#1', 'Brand#2'))",
            base.thresholds_sql("e", "quantile_cont"),
            select="""SELECT style, year_month, promotion_count, count(*) AS n, promotion_count >= p80 AS reaches_p80,
  promotion_count >= p90 AS reaches_p90
FROM prepared JOIN e USING (style, year_month) GROUP BY style, year_month, promotion_count, p80, p90""",
        ),
    ),
    "method_comparison": Entry(
        method_comparison, with_(*METHODS, select=rounded_sql() + " WHERE percentile = 'P80'")
    ),
    "changed_groups": Entry(changed_groups, with_(*METHODS, select=rounded_sql() + " WHERE changed_order_count > 0")),
    "top_changes": Entry(
        top_changes,
        with_(
            *METHODS,
            select=rounded_sql()
            + """ WHERE changed_order_count > 0
ORDER BY changed_order_count DESC, style, year_month, percentile LIMIT 10""",
        ),
    ),
    "comparison_summary": Entry(
        comparison_summary,
        with_(
            *METHODS,
            select="""SELECT percentile, count(*) AS total_groups,
  count(*) FILTER (threshold_diff > 1e-9) AS threshold_changed_groups,
  count(*) FILTER (changed_order_count > 0) AS set_changed_groups,
  count(*) FILTER (stddev_diff > 1e-9) AS stddev_changed_groups,
  round(avg(threshold_diff), 6) AS mean_threshold_diff FROM comparison GROUP BY percentile""",
        ),
    ),
}
