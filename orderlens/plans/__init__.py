"""The four analyses and the record views they start from."""

from orderlens.plans.records import bought_records, percentile_records, promotion_records, variety_records
from orderlens.plans.workloads import (
    PercentileResults,
    percentages_of,
    percentile_statistics,
    promotion_percentages,
    trailing_winners,
    variety_medians,
    variety_quality,
)

__all__ = [
    "PercentileResults",
    "bought_records",
    "percentages_of",
    "percentile_records",
    "percentile_statistics",
    "promotion_percentages",
    "promotion_records",
    "trailing_winners",
    "variety_medians",
    "variety_quality",
    "variety_records",
]
