"""The four analyses as jobs: a sales CSV in, a report out.

    spark-submit --py-files orderlens.zip orderlens/plans/jobs.py percentiles IN OUT

With ``--workspace``, a folder that all executors reach, pre-aggregated tables are kept there while a job runs.
"""

from __future__ import annotations

import argparse
from collections.abc import Sequence
from contextlib import ExitStack

from pyspark.sql import DataFrame, Observation, SparkSession

from orderlens.functions.moments import DEFAULT_SCALE
from orderlens.operators.checks import assert_unique_key, observed_profile
from orderlens.operators.comparison import summarize_comparison, top_changes
from orderlens.operators.lookup import Workspace
from orderlens.operators.percentiles import ACCURACY, group_sizes
from orderlens.operators.windows import LONG_DAYS, SHORT_DAYS, THRESHOLD
from orderlens.plans import workloads
from orderlens.plans.records import percentile_records, promotion_records
from orderlens.sources import readers, writers


def winners(
    spark: SparkSession,
    source: str,
    target: str,
    files: int | None = None,
    threshold: int = THRESHOLD,
    short: int = SHORT_DAYS,
    long: int = LONG_DAYS,
    scale: int = DEFAULT_SCALE,
    lenient: bool = True,
    workspace: Workspace | None = None,
) -> dict[str, DataFrame]:
    """CSV by state and date: the size bought most in the days before. Returns what the run used and skipped."""
    rows, counters = readers.read_sales_rows(spark, source, unescape_quotes=False), Observation()
    report = workloads.trailing_winners(rows, threshold, short, long, scale, lenient, workspace, counters)
    writers.write_report(report, target, ["state", "window_date"], files)
    return {"rows used and skipped": observed_profile(spark, counters)}


def medians(
    spark: SparkSession,
    source: str,
    target: str,
    files: int | None = None,
    scale: int = DEFAULT_SCALE,
    lenient: bool = True,
    workspace: Workspace | None = None,
) -> dict[str, DataFrame]:
    """CSV by month and state: the median variety of styles that come in XXL or bigger. ``scale`` has no part in it.
    Returns what the run used and skipped.
    """
    counters = Observation()
    report = workloads.variety_medians(readers.read_sales_rows(spark, source), lenient, workspace, counters)
    writers.write_report(report, target, ["month", "state"], files)
    return {"rows used and skipped": observed_profile(spark, counters)}


def percentages(
    spark: SparkSession,
    source: str,
    target: str,
    files: int | None = None,
    malformed: str = "null",
    scale: int = DEFAULT_SCALE,
    workspace: Workspace | None = None,
) -> None:
    """Parquet by city: the percentage of cancelled standard records that qualify."""
    rows = promotion_records(readers.read_sales(spark, source), malformed)
    writers.write_results(workloads.percentages_of(rows, scale, workspace), target, files)


def percentiles(
    spark: SparkSession,
    source: str,
    target: str,
    files: int | None = None,
    malformed: str = "null",
    accuracy: int = ACCURACY,
    scale: int = DEFAULT_SCALE,
    workspace: Workspace | None = None,
) -> dict[str, DataFrame]:
    """Parquet by SKU, month and method: thresholds and spreads. Returns the tables that describe the outcome; with a
    workspace, look at them before it closes.
    """
    rows = percentile_records(readers.read_sales_strict(spark, source), malformed)
    rows = rows.select(*workloads.GROUP, "promotion_count", "amount_value")
    results = workloads.percentile_statistics(rows, accuracy=accuracy, scale=scale, workspace=workspace)
    writers.write_methods(results.approx, results.exact, target, files)
    groups = rows.dropna(subset=list(workloads.GROUP)).select(*workloads.GROUP).distinct().count()
    assert_unique_key(readers.read_results(spark, target), [*workloads.GROUP, "method"], 2 * groups)
    return {
        "groups": group_sizes(rows, workloads.GROUP),
        "summary": summarize_comparison(results.comparison),
        "largest changes": top_changes(results.comparison, workloads.GROUP),
    }


JOBS = {"winners": winners, "medians": medians, "percentages": percentages, "percentiles": percentiles}


def main(arguments: Sequence[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description="Analyses of a sales CSV.")
    parser.add_argument("job", choices=JOBS)
    parser.add_argument("source", help="CSV file or folder")
    parser.add_argument("target", help="folder to (over)write")
    parser.add_argument("--files", type=int, help="number of output files; default: one per task")
    parser.add_argument("--scale", type=int, default=DEFAULT_SCALE, help="decimals that amounts are kept to")
    parser.add_argument("--workspace", help="shared folder for tables that live as long as the job")
    options = parser.parse_args(arguments)
    spark = SparkSession.builder.appName(f"orderlens-{options.job}").getOrCreate()
    with ExitStack() as stack:
        kept = stack.enter_context(Workspace(spark, options.workspace)) if options.workspace else None
        run = JOBS[options.job]
        tables = run(spark, options.source, options.target, options.files, scale=options.scale, workspace=kept)
        for title, table in (tables or {}).items():
            print(title)
            table.show(truncate=False)


if __name__ == "__main__":
    main()
