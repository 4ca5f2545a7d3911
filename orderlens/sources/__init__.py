"""Readers, sinks and the sample records."""

from orderlens.sources.readers import (
    line_quality,
    read_results,
    read_sales,
    read_sales_lines,
    read_sales_rows,
    read_sales_strict,
)
from orderlens.sources.sample import as_raw, sales
from orderlens.sources.schema import SALES_COLUMNS, SALES_SCHEMA
from orderlens.sources.writers import write_methods, write_report, write_results

__all__ = [
    "SALES_COLUMNS",
    "SALES_SCHEMA",
    "as_raw",
    "line_quality",
    "read_results",
    "read_sales",
    "read_sales_lines",
    "read_sales_rows",
    "read_sales_strict",
    "sales",
    "write_methods",
    "write_report",
    "write_results",
]
