"""The four analyses, end to end: text records in, report out."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from orderlens.functions.moments import DEFAULT_SCALE
from orderlens.operators import percentiles as pct
from orderlens.operators import promotions as promo
from orderlens.operators.checks import quality_profile
from orderlens.operators.comparison import compare_columns
from orderlens.operators.lookup import Workspace, staged
from orderlens.operators.variety import median_variety, qualified_variety, variety_rules
from orderlens.operators.windows import LONG_DAYS, SHORT_DAYS, THRESHOLD, trailing_window_winner
from orderlens.plans import records

GROUP = ("SKU", "year_month")


def trailing_winners(
    raw: DataFrame,
    threshold: int = THRESHOLD,
    short: int = SHORT_DAYS,
    long: int = LONG_DAYS,
    scale: int = DEFAULT_SCALE,
    lenient: bool = True,
    workspace: Workspace | None = None,
    counters: Observation | None = None,
) -> DataFrame:
    """state, window_date, most_bought_size, frequency, population_variance."""
    rows = records.bought_records(raw, lenient)
    return trailing_window_winner(
        rows, threshold=threshold, short=short, long=long, scale=scale, workspace=workspace, counters=counters
    )


def variety_medians(
    raw: DataFrame, lenient: bool = True, workspace: Workspace | None = None, counters: Observation | None = None
) -> DataFrame:
    """month, state, median_variety."""
    return median_variety(records.variety_records(raw, lenient), workspace=workspace, counters=counters)


def variety_quality(raw: DataFrame, lenient: bool = True, workspace: Workspace | None = None) -> DataFrame:
    """What the variety medians used and skipped, as rows (rule, rows). A run of the medians with ``counters`` tells the
    same by the way. It takes one read of ``raw``, so there is nothing to keep in a workspace.
    """
    found = qualified_variety(records.variety_records(raw, lenient))
    return quality_profile(found, variety_rules("month", F.col("valid")))


def promotion_percentages(
    raw: DataFrame, malformed: str = "null", scale: int = DEFAULT_SCALE, workspace: Workspace | None = None
) -> DataFrame:
    """city, percentage: of cancelled standard records, those with 3 lasting promotions and a below-average amount."""
    return percentages_of(records.promotion_records(raw, malformed), scale, workspace)


def percentages_of(orders: DataFrame, scale: int = DEFAULT_SCALE, workspace: Workspace | None = None) -> DataFrame:
    """``promotion_percentages`` of ``records.promotion_records``.

    The records are read for the promotions' spans, for the orders' promotions, and for the amounts. In a workspace
    the amounts of shipped and of cancelled records are one narrow table, without the promotion lists; else these two
    are separate reads.
    """
    appearances = promo.promotion_appearances(orders)
    counts = promo.valid_promotion_counts(appearances, promo.valid_promotions(appearances), workspace=workspace)
    amounts = orders.where("merchant_shipped OR cancelled_standard").drop("promotion_ids", "order_date")
    if workspace is not None:
        same = ("order_id", "city", "state", "amount", "merchant_shipped", "cancelled_standard")
        amounts = workspace.stage(amounts.select(*same), "amounts")
    averages = promo.benchmark_averages(amounts.where("merchant_shipped"), scale=scale)
    cancelled = amounts.where("cancelled_standard")
    return promo.below_benchmark_percentage(cancelled, counts, averages, scale=scale, workspace=workspace)


@dataclass(frozen=True)
class PercentileResults:
    """Threshold statistics by both methods, and their comparison."""

    approx: DataFrame
    exact: DataFrame
    comparison: DataFrame


def percentile_statistics(
    prepared: DataFrame,
    keys: tuple[str, ...] = GROUP,
    value: str = "promotion_count",
    amount: str = "amount_value",
    accuracy: int = pct.ACCURACY,
    scale: int = DEFAULT_SCALE,
    workspace: Workspace | None = None,
) -> PercentileResults:
    """Thresholds and spread per group, approximate and exact, of ``records.percentile_records``.

    The rows are folded into one histogram, and all four levels of a group are read off it together, so both methods'
    thresholds and statistics come from one aggregation of one read, and the comparison is a projection. The approximate
    levels are nearest ranks: those of ``percentile_approx`` for groups of less than ``accuracy / 2`` rows, and within its
    tolerance for larger ones. A workspace keeps the histogram and the outcome. Groups with a null key have no part in
    any of the results.
    """
    if accuracy <= 0:
        raise ValueError("accuracy must be greater than 0")
    known = prepared
    for k in keys:
        known = known.where(F.col(k).isNotNull())
    profile = staged(pct.value_profile(known, keys, value, amount, scale), workspace, "profile")
    levels = [
        pct.Level(f"{method}_{pct.level_name(p)}", p, method == "exact")
        for method in ("approx", "exact")
        for p in pct.PROBABILITIES
    ]
    outcome = pct.profile_levels(profile, keys, value, levels, scale, accuracy)
    both = staged(outcome, workspace, "statistics")

    def of(method: str) -> DataFrame:
        mine = [name for name in both.columns if name.startswith(f"{method}_")]
        return both.select(*keys, "order_count", *(F.col(name).alias(name.removeprefix(f"{method}_")) for name in mine))

    return PercentileResults(of("approx"), of("exact"), compare_columns(both, keys))
