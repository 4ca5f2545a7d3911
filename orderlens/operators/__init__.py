"""Operators: DataFrames in, one DataFrame out, column names as parameters."""

from orderlens.operators.checks import (
    assert_unique_key,
    key_profile,
    quality_profile,
    rows_per_method,
    value_range,
)
from orderlens.operators.comparison import (
    changed_groups,
    compare_columns,
    compare_levels,
    compare_methods,
    summarize_comparison,
    tag_methods,
    timing_summary,
    top_changes,
)
from orderlens.operators.lookup import Lookup, Workspace, lookup_join, staged
from orderlens.operators.percentiles import (
    approx_statistics,
    approx_thresholds,
    exact_statistics,
    exact_thresholds,
    group_sizes,
    profile_levels,
    profile_statistics,
    profile_thresholds,
    threshold_statistics,
    value_profile,
)
from orderlens.operators.promotions import (
    below_benchmark,
    below_benchmark_percentage,
    benchmark_averages,
    is_cancelled_standard,
    is_merchant_shipped,
    promotion_appearances,
    promotion_spans,
    qualifying_share,
    valid_promotion_counts,
    valid_promotions,
)
from orderlens.operators.variety import is_big_size, median_variety, qualifying_styles, style_variety
from orderlens.operators.windows import (
    daily_cells,
    is_bought,
    key_counts,
    pick_winners,
    trailing_buckets,
    trailing_window_winner,
    window_length,
    window_quality,
)

__all__ = [
    "Lookup",
    "Workspace",
    "approx_statistics",
    "approx_thresholds",
    "assert_unique_key",
    "below_benchmark",
    "below_benchmark_percentage",
    "benchmark_averages",
    "changed_groups",
    "compare_columns",
    "compare_levels",
    "compare_methods",
    "daily_cells",
    "exact_statistics",
    "exact_thresholds",
    "group_sizes",
    "is_big_size",
    "is_bought",
    "is_cancelled_standard",
    "is_merchant_shipped",
    "key_counts",
    "key_profile",
    "lookup_join",
    "median_variety",
    "pick_winners",
    "profile_levels",
    "profile_statistics",
    "profile_thresholds",
    "promotion_appearances",
    "promotion_spans",
    "qualifying_share",
    "qualifying_styles",
    "quality_profile",
    "rows_per_method",
    "staged",
    "style_variety",
    "summarize_comparison",
    "tag_methods",
    "threshold_statistics",
    "timing_summary",
    "top_changes",
    "trailing_buckets",
    "trailing_window_winner",
    "valid_promotion_counts",
    "valid_promotions",
    "value_profile",
    "value_range",
    "window_length",
    "window_quality",
]
