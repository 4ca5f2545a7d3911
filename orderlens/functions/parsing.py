"""Tolerant parsing. Spark 4 runs in ANSI mode, where a plain cast of bad text aborts the job."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DATE_PATTERN = "MM-dd-yy"
MALFORMED_MODES = ("null", "fail")


def _check(malformed: str) -> None:
    if malformed not in MALFORMED_MODES:
        raise ValueError(f"malformed must be one of {MALFORMED_MODES}, got {malformed!r}")


def parse_date(c: Column, malformed: str = "null", pattern: str = DATE_PATTERN) -> Column:
    """Text to date. Days that do not exist (02-30-22) are malformed; ``parse_date_leniently`` takes them."""
    _check(malformed)
    return F.try_to_date(c, pattern) if malformed == "null" else F.to_date(c, pattern)


def parse_date_leniently(c: Column) -> Column:
    """``MM-dd-yy`` text to a date of 2000 to 2099; days 29 to 31 that a month lacks are its last day. Else null."""
    month, day, year = (F.substring(c, start, 2).try_cast("int") for start in (1, 4, 7))
    first = F.make_date(year + 2000, month, F.lit(1))
    well_formed = c.rlike(r"^[0-9]{2}-[0-9]{2}-[0-9]{2}$") & month.between(1, 12) & day.between(1, 31)
    return F.when(well_formed, F.date_add(first, F.least(day, F.dayofmonth(F.last_day(first))) - 1))


def parse_double(c: Column, malformed: str = "null") -> Column:
    _check(malformed)
    return c.try_cast("double") if malformed == "null" else c.cast("double")


def month_of(c: Column) -> Column:
    """``yyyy-MM`` of a date, cut from its ISO text: the same as ``date_format`` up to the year 9999, but cheaper."""
    return F.substring(c.cast("string"), 1, 7)
