"""Sinks. All overwrite.

``files`` is the number of output files. Left at None, Spark writes one per task. A single file means a single
writing task, for reports only: it is made by an extra shuffle of the finished rows, so the work before it keeps
its parallelism.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from orderlens.operators.comparison import tag_methods


def write_results(df: DataFrame, path: str, files: int | None = None) -> None:
    """Parquet, with no cap on the rows of a file."""
    shaped = df if files is None else df.repartition(files)
    shaped.write.mode("overwrite").option("maxRecordsPerFile", 0).parquet(path)


def write_methods(approx: DataFrame, exact: DataFrame, path: str, files: int | None = None) -> None:
    """Both methods' results in one dataset, told apart by ``method``."""
    write_results(tag_methods(approx=approx, exact=exact), path, files)


def write_report(df: DataFrame, path: str, sort_by: Sequence[str], files: int | None = None) -> None:
    """CSV with a header, rows in ``sort_by`` order within and across files; values are quoted where needed."""
    if files is None:
        ordered = df.orderBy(*sort_by)
    else:
        ordered = df.repartitionByRange(files, *sort_by).sortWithinPartitions(*sort_by)
    ordered.write.mode("overwrite").option("header", True).csv(path)
