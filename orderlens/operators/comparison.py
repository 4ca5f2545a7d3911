"""Approximate against exact: per group, in summary, and the groups that differ most."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TOLERANCE = 1e-9
LEVELS = ("p80", "p90")
# The measures a level is compared by, and the names they get behind "approx_" and "exact_".
MEASURES = {"threshold": "{level}", "selected": "{level}_order_count", "stddev": "{level}_stddev"}


def _level_struct(level: str, separator: str = ".") -> Column:
    sides = {
        f"{side}_{name}": F.col(side + separator + column.format(level=level))
        for name, column in MEASURES.items()
        for side in ("approx", "exact")
    }
    count = F.col("approx.order_count" if separator == "." else "order_count")
    gap = {name: F.abs(sides[f"approx_{name}"] - sides[f"exact_{name}"]) for name in MEASURES}
    return F.struct(
        F.lit(level.upper()).alias("percentile"),
        count.alias("order_count"),
        *[column.alias(name) for name, column in sides.items()],
        gap["threshold"].alias("threshold_diff"),
        gap["selected"].alias("changed_order_count"),
        gap["stddev"].alias("stddev_diff"),
    )


def compare_columns(both: DataFrame, keys: Sequence[str], levels: Sequence[str] = LEVELS) -> DataFrame:
    """``compare_levels`` of one table with both methods' columns, named ``approx_...`` and ``exact_...``: no join."""
    return both.select(*keys, F.inline(F.array(*[_level_struct(level, "_") for level in levels])))


def compare_levels(
    approx: DataFrame, exact: DataFrame, keys: Sequence[str], levels: Sequence[str] = LEVELS
) -> DataFrame:
    """One row per group and level, from a single join of the two results.

    Both select by value >= threshold, so one selection contains the other and the difference of their sizes is the
    number of rows that changed sides.
    """
    unknown = [level for level in levels if level not in LEVELS]
    if unknown or not levels:
        raise ValueError(f"levels must be among {LEVELS}, got {list(levels)}")
    return (
        approx.alias("approx")
        .join(exact.alias("exact"), list(keys), "inner")
        .select(*keys, F.inline(F.array(*[_level_struct(level) for level in levels])))
    )


def compare_methods(approx: DataFrame, exact: DataFrame, percentile: str, keys: Sequence[str]) -> DataFrame:
    """``compare_levels`` for one level, ``p80`` or ``p90``."""
    return compare_levels(approx, exact, keys, (percentile,))


def summarize_comparison(comparison: DataFrame, tolerance: float = TOLERANCE) -> DataFrame:
    """Per level: groups in all, groups whose threshold, selection or spread differ, and the mean threshold gap."""
    return (
        comparison.groupBy("percentile")
        .agg(
            F.count(F.lit(1)).alias("total_groups"),
            F.count_if(F.col("threshold_diff") > tolerance).alias("threshold_changed_groups"),
            F.count_if(F.col("changed_order_count") > 0).alias("set_changed_groups"),
            F.count_if(F.col("stddev_diff") > tolerance).alias("stddev_changed_groups"),
            F.avg("threshold_diff").alias("mean_threshold_diff"),
        )
        .orderBy("percentile")
    )


def changed_groups(comparison: DataFrame) -> DataFrame:
    return comparison.where(F.col("changed_order_count") > 0)


def top_changes(comparison: DataFrame, keys: Sequence[str], limit: int = 10) -> DataFrame:
    """The groups whose selection differs most; ties in key and level order."""
    return changed_groups(comparison).orderBy(F.desc("changed_order_count"), *keys, "percentile").limit(limit)


def tag_methods(**results: DataFrame) -> DataFrame:
    """Stack results of one schema, each row marked with the ``method`` that made it."""
    if not results:
        raise ValueError("give at least one result")
    tagged = [df.withColumn("method", F.lit(name)) for name, df in results.items()]
    stacked = tagged[0]
    for df in tagged[1:]:
        stacked = stacked.unionByName(df)
    return stacked


def timing_summary(measurements: DataFrame, method: str = "method", seconds: str = "seconds") -> DataFrame:
    """Runs, mean and sample standard deviation of the seconds per method."""
    return (
        measurements.groupBy(method)
        .agg(
            F.count(F.lit(1)).alias("measured_runs"),
            F.avg(seconds).alias("mean_seconds"),
            F.stddev_samp(seconds).alias("stddev_seconds"),
        )
        .orderBy(method)
    )
