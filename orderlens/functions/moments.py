"""Exact, mergeable moments of an amount.

Float sums depend on the order in which partitions merge, which makes an equal-variance tie-break a coin toss.
Amounts are therefore held as whole units of ``10**-scale`` in decimals, so count, sum and sum of squares add up to the
same value in any order and at any grain.

With ``q`` the mean rounded to a whole unit, ``d = sum((x-q)^2)`` and ``r = sum(x-q)`` follow from those sums exactly,
and the variance is ``d/n - (r/n)^2``, which has no cancellation to speak of.

Limits. Amounts are rounded to ``scale`` decimals; those of more than ``2**53`` units are as exact as a double is. A
finite amount never becomes null: one of more than 28 digits in units, and squares of a group that sum to ``10**38``
units or more, end the job with an error.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DEFAULT_SCALE = 4
UNITS = "decimal(28,0)"
SUMS = "decimal(38,0)"


def units(amount: Column, scale: int = DEFAULT_SCALE) -> Column:
    """Amount in whole units of ``10**-scale``; null only where there is no finite number."""
    number = amount.try_cast("double")
    finite = F.coalesce(F.abs(number) < float("inf"), F.lit(False)) & ~F.isnan(number)
    whole = F.rint(number * float(10**scale)).try_cast(UNITS)
    too_big = F.raise_error(F.concat(F.lit("amount out of range: "), number.cast("string"))).cast(UNITS)
    return F.when(finite, F.coalesce(whole, too_big))


def _kept(total: Column, n: Column) -> Column:
    """A sum that overflowed ends the job even where the session turns overflows into nulls."""
    return F.when(n > 0, F.coalesce(total, F.raise_error(F.lit("sum of amounts out of range")).cast(SUMS)))


def sum_units(u: Column) -> Column:
    return _kept(F.sum(u).cast(SUMS), F.count(u))


def sum_squares(u: Column) -> Column:
    return _kept(F.sum(u * u).cast(SUMS), F.count(u))


def _centred(n: Column, s: Column, ss: Column) -> tuple[Column, Column, Column]:
    count = n.cast("decimal(20,0)")
    q = F.round(s.cast("double") / F.when(n > 0, n)).cast(UNITS)
    r = s - q * count
    d = ss - q * (s + r)
    return count, r, d


def variance(n: Column, s: Column, ss: Column, scale: int = DEFAULT_SCALE) -> Column:
    """Population variance as double, in squared amounts; null for an empty group."""
    _, r, d = _centred(n, s, ss)
    mean_off = r.cast("double") / n
    raw = d.cast("double") / n - mean_off * mean_off
    return F.when(raw < 0, 0.0).otherwise(raw) / float(10 ** (2 * scale))


def spread(n: Column, s: Column, ss: Column) -> Column:
    """Orders groups of equal ``n`` by their exact variance, without the product of ``n`` and the sum of squares.

    With ``r * r = k * n + rest`` the variance is ``(n * (d - k) - rest) / n^2``, so ``d - k`` decides, and of equals
    the larger rest is the smaller variance.
    """
    count, r, d = _centred(n, s, ss)
    square = r * r
    rest = (square % count).cast(SUMS)
    k = ((square - rest) / count).cast(SUMS)
    return F.struct((d - k).cast(SUMS).alias("lead"), (-rest).alias("rest"))


def stddev(n: Column, s: Column, ss: Column, scale: int = DEFAULT_SCALE) -> Column:
    return F.sqrt(variance(n, s, ss, scale))
