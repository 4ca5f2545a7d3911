"""Checks of a result that has been written, and counts of what a job used and skipped."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def sums_of(rules: dict[str, Column]) -> list[Column]:
    """One sum per rule, named after it. A rule is a condition, or a whole number to be added up; null adds nothing."""
    zero = F.lit(0).cast("bigint")
    return [F.coalesce(F.sum(rule.cast("bigint")), zero).alias(name) for name, rule in rules.items()]


def quality_profile(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """Rows that meet each rule, as (rule, rows), from one pass over ``df``."""
    pairs = [F.struct(F.lit(name).alias("rule"), F.col(f"`{name}`").alias("rows")) for name in rules]
    return df.agg(*sums_of(rules)).select(F.inline(F.array(*pairs)))


def observed_profile(spark: SparkSession, counters: Observation) -> DataFrame:
    """What ``counters`` saw during a run that is over, as (rule, rows).

    The counts come from the run itself, without another pass. Stages that are computed again after an executor was lost
    can count twice; ``quality_profile`` is the same as a query of its own, which cannot.
    """
    return spark.createDataFrame(list(counters.get.items()), "rule string, rows bigint")


def key_profile(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: rows, and distinct keys."""
    return (
        df.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("_n"))
        .agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("row_count"), F.count(F.lit(1)).alias("unique_keys"))
    )


def assert_unique_key(df: DataFrame, keys: Sequence[str], expected_rows: int | None = None) -> int:
    """Raise unless no key repeats and, if given, the row count is ``expected_rows``. Returns the row count."""
    rows, unique = key_profile(df, keys).first()
    if expected_rows is not None and rows != expected_rows:
        raise ValueError(f"expected {expected_rows} rows, found {rows}")
    if unique != rows:
        raise ValueError(f"{rows} rows share {unique} keys of {list(keys)}")
    return rows


def rows_per_method(df: DataFrame, method: str = "method") -> DataFrame:
    return df.groupBy(method).agg(F.count(F.lit(1)).alias("row_count"))


def value_range(df: DataFrame, column: str) -> DataFrame:
    return df.agg(F.min(column).alias(f"min_{column}"), F.max(column).alias(f"max_{column}"))
