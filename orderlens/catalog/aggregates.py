"""Aggregates, checks, and the four analyses end to end."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from orderlens.catalog import base
from orderlens.catalog.base import Entry, with_, with_raw
from orderlens.catalog.joins import METHODS, ROUNDED, merchant_averages, results, rounded, rounded_sql
from orderlens.functions import moments
from orderlens.operators import checks, variety, windows
from orderlens.operators import percentiles as pct
from orderlens.operators import promotions as promo
from orderlens.operators.comparison import tag_methods
from orderlens.plans import records, workloads
from orderlens.sources.sample import sales

LIMIT = base.TEST_THRESHOLD
STDDEVS = ("p80_stddev", "p90_stddev")


def state_counts(spark: SparkSession, folder: str) -> DataFrame:
    return windows.key_counts(base.bought(spark, folder))


def trailing_buckets(spark: SparkSession, folder: str) -> DataFrame:
    buckets = windows.trailing_buckets(base.bought(spark, folder), threshold=LIMIT, scale=2)
    return buckets.select("state", "window_date", "size", "n", F.col("s").cast("double"), F.col("ss").cast("double"))


def trailing_buckets_given_totals(spark: SparkSession, folder: str) -> DataFrame:
    """Windows whose lengths come from a table of counts; states that it lacks have no windows."""
    rows = base.bought(spark, folder)
    busy = windows.key_counts(rows).where(F.col("n") > LIMIT)
    buckets = windows.trailing_buckets(rows, threshold=LIMIT, totals=busy, scale=2)
    return buckets.select("state", "window_date", "size", "n")


def category_moments(spark: SparkSession, folder: str) -> DataFrame:
    """Count and population variance of the amounts per state and size; a missing amount is left out here."""
    u = moments.units(F.col("amount"), 2)
    n, s, ss = F.col("n"), F.col("s"), F.col("ss")
    sums = sales(spark, folder).groupBy("state", "size").agg(
        F.count(u).alias("n"), moments.sum_units(u).alias("s"), moments.sum_squares(u).alias("ss")
    )
    deviation = moments.stddev(n, s, ss, 2)
    return sums.select("state", "size", "n", F.round(deviation, 4).alias("amount_stddev"))


def trailing_window_winner(spark: SparkSession, folder: str) -> DataFrame:
    winners = windows.trailing_window_winner(base.bought(spark, folder), threshold=LIMIT, scale=2)
    return rounded(winners, ("population_variance",))


def split_window_winner(spark: SparkSession, folder: str) -> DataFrame:
    """Both window lengths at any size of the tables: a state is busy above the average state."""
    rows = base.bought(spark, folder)
    mean = windows.key_counts(rows).agg(F.avg("n")).first()[0] or 0
    return rounded(windows.trailing_window_winner(rows, threshold=int(mean), scale=2), ("population_variance",))


def trailing_style_winner(spark: SparkSession, folder: str) -> DataFrame:
    """The same operator on other columns: the style bought most per city, in 3 or 7 days."""
    winners = windows.trailing_window_winner(
        base.bought(spark, folder), key="city", category="style", threshold=LIMIT, short=3, long=7, scale=2
    )
    return rounded(winners, ("population_variance",))


def window_quality(spark: SparkSession, folder: str) -> DataFrame:
    """Rows of odd months have a bad date, free sizes are blank, and only busy states have a count."""
    rows = base.bought(spark, folder)
    busy = windows.key_counts(rows).where(F.col("n") > LIMIT)
    spoiled = rows.withColumns(
        {
            "order_date": F.when(F.month("order_date") % 2 == 0, F.col("order_date")),
            "size": F.when(F.col("size") == "Free", "").otherwise(F.col("size")),
        }
    )
    return windows.window_quality(spoiled, threshold=2 * LIMIT, totals=busy)


def observed_window_quality(spark: SparkSession, folder: str) -> DataFrame:
    """The counters that a run of the winners brings along; the run's own rows are not looked at."""
    rows, counters = base.bought(spark, folder), Observation()
    busy = windows.key_counts(rows).where(F.col("n") > LIMIT)
    undated = rows.withColumn("order_date", F.when(F.month("order_date") % 2 == 0, F.col("order_date")))
    winners = windows.trailing_window_winner(undated, threshold=2 * LIMIT, totals=busy, counters=counters)
    winners.write.format("noop").mode("overwrite").save()
    return checks.observed_profile(spark, counters)


def observed_variety_quality(spark: SparkSession, folder: str) -> DataFrame:
    """The counters that a run of the medians brings along."""
    counters = Observation()
    variety.median_variety(base.monthly(spark, folder), counters=counters).write.format("noop").mode("overwrite").save()
    return checks.observed_profile(spark, counters)


def qualifying_styles(spark: SparkSession, folder: str) -> DataFrame:
    return variety.qualifying_styles(sales(spark, folder))


def style_variety(spark: SparkSession, folder: str) -> DataFrame:
    return variety.style_variety(base.monthly(spark, folder)).select("month", "state", "style", "variety")


def median_variety(spark: SparkSession, folder: str) -> DataFrame:
    return variety.median_variety(base.monthly(spark, folder))


def median_variety_given_styles(spark: SparkSession, folder: str) -> DataFrame:
    """Cities instead of states, and only styles that someone has bought for a high amount."""
    rows = base.monthly(spark, folder)
    styles = rows.where("amount > 100000").select("style")
    return variety.median_variety(rows, group="city", styles=styles)


def variety_quality(spark: SparkSession, folder: str) -> DataFrame:
    """Platform records have an unreadable date and cancelled ones a blank SKU."""
    spoiled = (
        base.raw(spark, folder)
        .withColumn("Date", F.when(F.col("Fulfilment") == "Platform", "13-45-99").otherwise(F.col("Date")))
        .withColumn("SKU", F.when(F.col("Status") == "Cancelled", " ").otherwise(F.col("SKU")))
    )
    return workloads.variety_quality(spoiled)


def promotion_spans(spark: SparkSession, folder: str) -> DataFrame:
    return promo.promotion_spans(promo.promotion_appearances(sales(spark, folder)))


def valid_promotions(spark: SparkSession, folder: str) -> DataFrame:
    return promo.valid_promotions(promo.promotion_appearances(sales(spark, folder)))


def benchmark_averages(spark: SparkSession, folder: str) -> DataFrame:
    averages = merchant_averages(base.lowered(spark, folder))
    return averages.select("state", "n", F.round("average", 4).alias("average"))


def below_benchmark_percentage(spark: SparkSession, folder: str) -> DataFrame:
    return workloads.percentages_of(base.lowered(spark, folder), workspace=base.workspace(spark))


def percentage_range(spark: SparkSession, folder: str) -> DataFrame:
    return checks.value_range(below_benchmark_percentage(spark, folder), "percentage")


def approx_thresholds(spark: SparkSession, folder: str) -> DataFrame:
    return pct.approx_thresholds(base.prepared(spark, folder), base.GROUP)


def exact_thresholds(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(pct.exact_thresholds(base.prepared(spark, folder), base.GROUP), ("p80", "p90"), 9)


def exact_quartiles(spark: SparkSession, folder: str) -> DataFrame:
    """Other levels of another value: quartiles of the quantity per state."""
    levels = pct.exact_thresholds(sales(spark, folder), ["state"], "qty", (0.25, 0.5, 0.75))
    return rounded(levels, ("p25", "p50", "p75"), 9)


def exact_price_percentiles(spark: SparkSession, folder: str) -> DataFrame:
    """Levels of a value with nearly as many distinct values as rows."""
    levels = pct.exact_thresholds(sales(spark, folder), ["state"], "amount")
    return rounded(levels, ("p80", "p90"))


def promotion_count_profile(spark: SparkSession, folder: str) -> DataFrame:
    return pct.value_profile(base.prepared(spark, folder), base.GROUP)


def approx_statistics(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(pct.approx_statistics(base.prepared(spark, folder), base.GROUP), STDDEVS)


def exact_statistics(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(pct.exact_statistics(base.prepared(spark, folder), base.GROUP), ("p80", "p90", *STDDEVS))


def given_threshold_statistics(spark: SparkSession, folder: str) -> DataFrame:
    """Thresholds of one table, a style's over all months, for another's groups: these have to be joined."""
    rows = base.prepared(spark, folder)
    levels = pct.approx_thresholds(rows, ["style"])
    return rounded(pct.threshold_statistics(rows, levels, ["style"]), STDDEVS)


def group_sizes(spark: SparkSession, folder: str) -> DataFrame:
    return pct.group_sizes(base.prepared(spark, folder), base.GROUP, 30)


def method_tags(spark: SparkSession, folder: str) -> DataFrame:
    approx, exact = results(spark, folder)
    return rounded(tag_methods(approx=approx, exact=exact), ("p80", "p90", *STDDEVS))


def rows_per_method(spark: SparkSession, folder: str) -> DataFrame:
    approx, exact = results(spark, folder)
    return checks.rows_per_method(tag_methods(approx=approx, exact=exact))


def distinct_method_keys(spark: SparkSession, folder: str) -> DataFrame:
    approx, exact = results(spark, folder)
    return tag_methods(approx=approx, exact=exact).select(*base.GROUP, "method").distinct()


def key_profile(spark: SparkSession, folder: str) -> DataFrame:
    """Rows against distinct (order, sku) keys; the records do repeat some."""
    return checks.key_profile(sales(spark, folder), ["order_id", "sku"])


def quality_profile(spark: SparkSession, folder: str) -> DataFrame:
    rules = {
        "missing_amount": F.col("amount").isNull(),
        "bought": windows.is_bought(F.col("status"), F.col("qty")),
        "big_size": variety.is_big_size(F.col("size")),
        "total_qty": F.col("qty").cast("bigint"),
    }
    return checks.quality_profile(sales(spark, folder), rules)


def raw_trailing_winners(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(workloads.trailing_winners(base.raw(spark, folder), LIMIT), ("population_variance",))


def raw_variety_medians(spark: SparkSession, folder: str) -> DataFrame:
    return workloads.variety_medians(base.raw(spark, folder))


def raw_promotion_percentages(spark: SparkSession, folder: str) -> DataFrame:
    return workloads.promotion_percentages(base.raw(spark, folder), workspace=base.workspace(spark))


def raw_percentile_comparison(spark: SparkSession, folder: str) -> DataFrame:
    rows = records.percentile_records(base.raw(spark, folder))
    return rounded(workloads.percentile_statistics(rows).comparison, ROUNDED)


WINDOWS = (base.BOUGHT_SQL, base.COUNTS_SQL, base.BUCKETS_SQL)
MEDIAN_SQL = """SELECT month, {group}, CAST(median(variety) AS DOUBLE) AS median_variety FROM (
  SELECT strftime(order_date, '%Y-%m') AS month, {group}, style, count(DISTINCT sku) AS variety FROM sales
  WHERE style IN (SELECT style FROM sales WHERE {rule}) GROUP BY ALL) AS counted
GROUP BY month, {group}"""
BIG_RULE = "size IN ('XXL', '3XL')"
TAGGED_SQL = """SELECT * REPLACE (round(p80, 4) AS p80, round(p90, 4) AS p90, round(p80_stddev, 4) AS p80_stddev,
    round(p90_stddev, 4) AS p90_stddev), '{name}' AS method FROM {name}"""
SKU_KEYS = "sku, year_month"

SEEN_SQL = """SELECT 'BOUGHT_RECORDS' AS rule, count(*) AS rows FROM seen WHERE day IS NOT NULL AND total IS NOT NULL
UNION ALL SELECT 'MISSING_AMOUNT', count(*) FROM seen WHERE day IS NOT NULL AND total IS NOT NULL AND cents IS NULL
UNION ALL SELECT 'BUCKET_EMISSIONS', CAST(coalesce(sum(length), 0) AS BIGINT) FROM seen WHERE day IS NOT NULL AND total IS NOT NULL
UNION ALL SELECT 'INVALID_DATE', count(*) FROM seen WHERE day IS NULL
UNION ALL SELECT 'STATE_COUNT_MISSING', count(*) FROM seen WHERE day IS NOT NULL AND total IS NULL"""

ENTRIES = {
    "state_counts": Entry(
        state_counts, with_(base.BOUGHT_SQL, select="SELECT state, count(*) AS n FROM bought GROUP BY state")
    ),
    "trailing_buckets": Entry(
        trailing_buckets,
        with_(
            *WINDOWS,
            select="SELECT state, window_date, size, n, CAST(s AS DOUBLE) AS s, CAST(ss AS DOUBLE) AS ss FROM buckets",
        ),
    ),
    "trailing_buckets_given_totals": Entry(
        trailing_buckets_given_totals,
        with_(
            *WINDOWS,
            select=f"""SELECT state, window_date, size, n FROM buckets
WHERE state IN (SELECT state FROM counts WHERE total > {LIMIT})""",
        ),
    ),
    "category_moments": Entry(
        category_moments,
        with_(
            select="""SELECT state, size, count(amount) AS n, round(stddev_pop(amount), 4) AS amount_stddev
FROM sales GROUP BY state, size"""
        ),
    ),
    "trailing_window_winner": Entry(
        trailing_window_winner, with_(*WINDOWS, base.WINNERS_SQL, select="SELECT * FROM winners")
    ),
    "split_window_winner": Entry(
        split_window_winner,
        with_(
            base.BOUGHT_SQL,
            base.COUNTS_SQL,
            base.BUCKETS_SQL.replace(f"total > {LIMIT}", "total > (SELECT avg(total) FROM counts)"),
            base.WINNERS_SQL,
            select="SELECT * FROM winners",
        ),
    ),
    "trailing_style_winner": Entry(
        trailing_style_winner,
        with_(
            """bought AS (SELECT city, order_date, style, coalesce(CAST(round(amount * 100) AS HUGEINT), 0) AS cents
  FROM sales WHERE lower(status) LIKE '%shipped%' AND qty <> 0)""",
            "counts AS (SELECT city, count(*) AS total FROM bought GROUP BY city)",
            f"""buckets AS (
  SELECT bought.city, order_date + CAST(ahead AS INTEGER) AS window_date, style, count(*) AS n,
    sum(cents) AS s, sum(cents * cents) AS ss
  FROM bought JOIN counts ON bought.city = counts.city,
    unnest(range(1, CASE WHEN total > {LIMIT} THEN 4 ELSE 8 END)) AS t(ahead) GROUP BY ALL)""",
            select="""SELECT city, window_date, style AS most_bought_style, n AS frequency,
  round(CAST(n * ss - s * s AS DOUBLE) / CAST(n * n AS DOUBLE) / 10000.0, 4) AS population_variance
FROM buckets QUALIFY row_number() OVER (PARTITION BY city, window_date ORDER BY n DESC, n * ss - s * s, style) = 1""",
        ),
    ),
    "window_quality": Entry(
        window_quality,
        with_(
            base.BOUGHT_SQL,
            base.COUNTS_SQL,
            f"""seen AS (
  SELECT CASE WHEN month(order_date) % 2 = 0 THEN order_date END AS day, cents, total,
    CASE WHEN total > {2 * LIMIT} THEN 5 ELSE 10 END AS length
  FROM bought LEFT JOIN (SELECT * FROM counts WHERE total > {LIMIT}) AS known ON bought.state = known.state
  WHERE size <> 'Free')""",
            select=SEEN_SQL,
        ),
    ),
    "observed_window_quality": Entry(
        observed_window_quality,
        with_(
            base.BOUGHT_SQL,
            base.COUNTS_SQL,
            f"""seen AS (
  SELECT CASE WHEN month(order_date) % 2 = 0 THEN order_date END AS day, cents, total,
    CASE WHEN total > {2 * LIMIT} THEN 5 ELSE 10 END AS length
  FROM bought LEFT JOIN (SELECT * FROM counts WHERE total > {LIMIT}) AS known ON bought.state = known.state)""",
            select=SEEN_SQL,
        ),
    ),
    "observed_variety_quality": Entry(
        observed_variety_quality,
        with_(
            f"""seen AS (SELECT {BIG_RULE} AS big, style IN (SELECT style FROM sales WHERE {BIG_RULE}) AS valid FROM sales)""",
            select="""SELECT 'QUALIFYING_XXL_ROWS' AS rule, count(*) FILTER (big) AS rows FROM seen
UNION ALL SELECT 'BAD_DATE_ROWS', 0
UNION ALL SELECT 'MISSING_GROUP_FIELDS', 0
UNION ALL SELECT 'QUALIFIED_STYLE_ROWS', count(*) FILTER (valid) FROM seen""",
        ),
    ),
    "qualifying_styles": Entry(
        qualifying_styles, with_(select=f"SELECT DISTINCT style FROM sales WHERE {BIG_RULE}")
    ),
    "style_variety": Entry(
        style_variety,
        with_(
            select="""SELECT strftime(order_date, '%Y-%m') AS month, state, style, count(DISTINCT sku) AS variety
FROM sales GROUP BY ALL"""
        ),
    ),
    "median_variety": Entry(median_variety, with_(select=MEDIAN_SQL.format(group="state", rule=BIG_RULE))),
    "median_variety_given_styles": Entry(
        median_variety_given_styles, with_(select=MEDIAN_SQL.format(group="city", rule="amount > 100000"))
    ),
    "variety_quality": Entry(
        variety_quality,
        with_(
            f"""seen AS (SELECT fulfilment = 'Platform' AS bad_date, status = 'Cancelled' AS blank_sku, {BIG_RULE} AS big,
    style IN (SELECT style FROM sales WHERE {BIG_RULE}) AS valid FROM sales)""",
            select="""SELECT 'QUALIFYING_XXL_ROWS' AS rule, count(*) FILTER (big) AS rows FROM seen
UNION ALL SELECT 'BAD_DATE_ROWS', count(*) FILTER (valid AND bad_date) FROM seen
UNION ALL SELECT 'MISSING_GROUP_FIELDS', count(*) FILTER (valid AND NOT bad_date AND blank_sku) FROM seen
UNION ALL SELECT 'QUALIFIED_STYLE_ROWS', count(*) FILTER (valid AND NOT bad_date AND NOT blank_sku) FROM seen""",
        ),
    ),
    "promotion_spans": Entry(
        promotion_spans,
        with_(
            base.APPEARANCES_SQL,
            base.VALID_SQL.replace(" HAVING date_diff('day', min(order_date), max(order_date)) >= 2", ""),
            select="SELECT * FROM valid",
        ),
    ),
    "valid_promotions": Entry(
        valid_promotions, with_(base.APPEARANCES_SQL, base.VALID_SQL, select="SELECT * FROM valid")
    ),
    "benchmark_averages": Entry(
        benchmark_averages,
        with_(base.AVERAGES_SQL, select="SELECT state, n, round(average, 4) AS average FROM averages"),
    ),
    "below_benchmark_percentage": Entry(below_benchmark_percentage, base.PERCENTAGE_SQL),
    "percentage_range": Entry(
        percentage_range,
        f"""SELECT min(percentage) AS min_percentage, max(percentage) AS max_percentage
FROM ({base.PERCENTAGE_SQL}) AS percentages""",
    ),
    "approx_thresholds": Entry(
        approx_thresholds,
        with_(base.PREPARED_SQL, base.thresholds_sql("a", "quantile_disc"), select="SELECT * FROM a"),
    ),
    "exact_thresholds": Entry(
        exact_thresholds,
        with_(
            base.PREPARED_SQL,
            base.thresholds_sql("e", "quantile_cont"),
            select="SELECT * REPLACE (round(p80, 9) AS p80, round(p90, 9) AS p90) FROM e",
        ),
    ),
    "exact_quartiles": Entry(
        exact_quartiles,
        with_(
            select="""SELECT state, count(*) AS order_count, round(quantile_cont(qty, 0.25), 9) AS p25,
  round(quantile_cont(qty, 0.5), 9) AS p50, round(quantile_cont(qty, 0.75), 9) AS p75 FROM sales GROUP BY state"""
        ),
    ),
    "exact_price_percentiles": Entry(
        exact_price_percentiles,
        with_(
            select="""SELECT state, count(*) AS order_count, round(quantile_cont(amount, 0.8), 4) AS p80,
  round(quantile_cont(amount, 0.9), 4) AS p90 FROM sales GROUP BY state"""
        ),
    ),
    "promotion_count_profile": Entry(
        promotion_count_profile,
        with_(
            base.PREPARED_SQL,
            select="SELECT style, year_month, promotion_count, count(*) AS n FROM prepared GROUP BY ALL",
        ),
    ),
    "approx_statistics": Entry(
        approx_statistics,
        with_(
            base.PREPARED_SQL,
            base.thresholds_sql("a", "quantile_disc"),
            base.statistics_sql("approx", "a"),
            select="""SELECT * REPLACE (round(p80_stddev, 4) AS p80_stddev, round(p90_stddev, 4) AS p90_stddev)
FROM approx""",
        ),
    ),
    "exact_statistics": Entry(
        exact_statistics,
        with_(
            base.PREPARED_SQL,
            base.thresholds_sql("e", "quantile_cont"),
            base.statistics_sql("exact", "e"),
            select="""SELECT * REPLACE (round(p80, 4) AS p80, round(p90, 4) AS p90, round(p80_stddev, 4) AS p80_stddev,
  round(p90_stddev, 4) AS p90_stddev) FROM exact""",
        ),
    ),
    "given_threshold_statistics": Entry(
        given_threshold_statistics,
        with_(
            base.PREPARED_SQL,
            base.thresholds_sql("a", "quantile_disc", "style"),
            base.statistics_sql("given", "a", "style"),
            select="""SELECT * REPLACE (round(p80_stddev, 4) AS p80_stddev, round(p90_stddev, 4) AS p90_stddev)
FROM given""",
        ),
    ),
    "group_sizes": Entry(
        group_sizes,
        with_(
            base.PREPARED_SQL,
            select="""SELECT count(*) AS total_groups, max(n) AS largest_group, count(*) FILTER (n > 30) AS groups_over_30
FROM (SELECT count(*) AS n FROM prepared GROUP BY style, year_month) AS sizes""",
        ),
    ),
    "method_tags": Entry(
        method_tags,
        with_(
            *METHODS, select=TAGGED_SQL.format(name="approx") + "\nUNION ALL " + TAGGED_SQL.format(name="exact")
        ),
    ),
    "rows_per_method": Entry(
        rows_per_method,
        with_(
            *METHODS,
            select="""SELECT 'approx' AS method, count(*) AS row_count FROM approx
UNION ALL SELECT 'exact', count(*) FROM exact""",
        ),
    ),
    "distinct_method_keys": Entry(
        distinct_method_keys,
        with_(
            *METHODS,
            select="""SELECT DISTINCT style, year_month, 'approx' AS method FROM approx
UNION ALL SELECT DISTINCT style, year_month, 'exact' FROM exact""",
        ),
    ),
    "key_profile": Entry(
        key_profile,
        with_(
            select="""SELECT CAST(sum(n) AS BIGINT) AS row_count, count(*) AS unique_keys
FROM (SELECT count(*) AS n FROM sales GROUP BY order_id, sku) AS keyed"""
        ),
    ),
    "quality_profile": Entry(
        quality_profile,
        with_(
            select=f"""SELECT 'missing_amount' AS rule, count(*) FILTER (amount IS NULL) AS rows FROM sales
UNION ALL SELECT 'bought', count(*) FILTER (status LIKE 'Shipped%' AND qty <> 0) FROM sales
UNION ALL SELECT 'big_size', count(*) FILTER ({BIG_RULE}) FROM sales
UNION ALL SELECT 'total_qty', CAST(sum(qty) AS BIGINT) FROM sales"""
        ),
    ),
    "raw_trailing_winners": Entry(
        raw_trailing_winners,
        with_raw(
            *WINDOWS,
            base.WINNERS_SQL,
            select="SELECT * REPLACE (upper(state) AS state) FROM winners",
        ),
    ),
    "raw_variety_medians": Entry(
        raw_variety_medians, with_raw(select=MEDIAN_SQL.format(group="state", rule=BIG_RULE))
    ),
    "raw_promotion_percentages": Entry(
        raw_promotion_percentages, with_raw(*base.PERCENTAGE_CTES, select=base.PERCENTAGE_SELECT)
    ),
    "raw_percentile_comparison": Entry(
        raw_percentile_comparison,
        with_raw(
            base.PREPARED_SQL,
            base.thresholds_sql("a", "quantile_disc", SKU_KEYS),
            base.thresholds_sql("e", "quantile_cont", SKU_KEYS),
            base.statistics_sql("approx", "a", SKU_KEYS),
            base.statistics_sql("exact", "e", SKU_KEYS),
            base.comparison_sql(SKU_KEYS),
            'named AS (SELECT sku AS "SKU", * EXCLUDE (sku) FROM comparison)',
            select=rounded_sql("named"),
        ),
    ),
}
