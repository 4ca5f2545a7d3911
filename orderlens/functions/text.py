"""Text clean-up columns. All are built-in expressions; nothing leaves the JVM."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Garment sizes below the X-multiples, smallest first, and the first "big" rank (XXL).
LETTER_SIZES = {"XS": 1, "S": 2, "M": 3, "L": 4}
BIG_SIZE_RANK = 6


def strip(c: Column) -> Column:
    """Drop blanks and control characters (U+0000..U+0020) from both ends; ``F.trim`` drops spaces only."""
    return F.btrim(c, F.lit("".join(map(chr, range(0x21)))))


def strip_upper(c: Column) -> Column:
    return F.upper(strip(c))


def squeeze_upper(c: Column) -> Column:
    """``strip_upper`` with each inner run of whitespace turned into one space."""
    return F.upper(F.regexp_replace(strip(c), r"\s+", " "))


def has_text(c: Column) -> Column:
    """True when the text is neither null nor empty; never null."""
    return F.coalesce(F.length(c) > 0, F.lit(False))


def size_rank(c: Column) -> Column:
    """Order of a garment size: XS..L are 1..4, XL with n X's (or written nXL, n >= 2) is n + 4, else null.

    A digit form must start with 2-9, so ``10XL`` is unknown and ``20XL`` is 24.
    """
    size = F.upper(F.regexp_replace(c, r"\s+", ""))
    multiple = F.regexp_extract(size, r"^([2-9][0-9]*)XL$", 1).try_cast("int")
    rank = F.when(size.rlike("^X+L$"), F.length(size) + 3).otherwise(F.try_add(multiple, F.lit(4)))
    for name, value in LETTER_SIZES.items():
        rank = F.when(size == name, F.lit(value)).otherwise(rank)
    return rank.cast("int")


def tokens(c: Column, separator: str = ",") -> Column:
    """Split a separated list, trim each token of spaces, drop the blank ones, keep duplicates. Null gives [].

    The separator is plain text, whatever it means in a regular expression.
    """
    parts = F.split(F.coalesce(c, F.lit("")), re.escape(separator))
    return F.array_remove(F.transform(parts, lambda part: F.trim(part)), "")


def distinct_tokens(c: Column, separator: str = ",") -> Column:
    return F.array_distinct(tokens(c, separator))


def token_count(c: Column, separator: str = ",") -> Column:
    """Size of ``tokens``. A token is blank if nothing is left without its spaces, so they need not be trimmed one by one."""
    if " " in separator:
        return F.size(tokens(c, separator))
    dense = F.replace(F.coalesce(c, F.lit("")), F.lit(" "), F.lit(""))
    return F.size(F.array_remove(F.split(dense, re.escape(separator)), ""))
