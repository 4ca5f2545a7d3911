"""Column expressions."""

from orderlens.functions.moments import spread, stddev, units, variance
from orderlens.functions.parsing import month_of, parse_date, parse_date_leniently, parse_double
from orderlens.functions.text import (
    BIG_SIZE_RANK,
    distinct_tokens,
    has_text,
    size_rank,
    squeeze_upper,
    strip,
    strip_upper,
    token_count,
    tokens,
)

__all__ = [
    "BIG_SIZE_RANK",
    "distinct_tokens",
    "has_text",
    "month_of",
    "parse_date",
    "parse_date_leniently",
    "parse_double",
    "size_rank",
    "spread",
    "squeeze_upper",
    "stddev",
    "strip",
    "strip_upper",
    "token_count",
    "tokens",
    "units",
    "variance",
]
