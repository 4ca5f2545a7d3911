"""Trailing windows of a length that depends on the key, and the winner of each window."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from orderlens.functions import moments
from orderlens.functions.text import has_text
from orderlens.operators.checks import quality_profile, sums_of
from orderlens.operators.lookup import Workspace, lookup_join, staged

THRESHOLD = 10_000
SHORT_DAYS = 5
LONG_DAYS = 10
BLOCK_DAYS = 32


def is_bought(status: Column, qty: Column) -> Column:
    """Status mentions "shipped" in any case (returns included) and the quantity is a number other than 0."""
    amount = qty.try_cast("double")
    return F.coalesce(F.lower(status).contains("shipped") & (amount != 0), F.lit(False))


def key_counts(bought: DataFrame, key: str = "state") -> DataFrame:
    """Bought rows per key. Their date and category do not matter here."""
    return bought.where(has_text(F.col(key))).groupBy(key).agg(F.count(F.lit(1)).alias("n"))


def window_length(
    n: Column, threshold: int = THRESHOLD, short: int = SHORT_DAYS, long: int = LONG_DAYS
) -> Column:
    """Busy keys, with more than ``threshold`` rows, look back ``short`` days, the others ``long``."""
    return F.when(n > threshold, F.lit(short)).otherwise(F.lit(long))


def daily_cells(
    bought: DataFrame, key: str, date: str, category: str, amount: str, scale: int = moments.DEFAULT_SCALE
) -> DataFrame:
    """Count and amount moments per (key, day, category), the grain that all windows are made of.

    Rows without a date or category stay in as cells of their own: they count for their key's total. A missing
    amount is 0.

    The closing condition holds for every cell. It names all measures, so that whoever uses the cells twice, for windows
    and for totals, asks for the same columns and Spark computes them once.
    """
    u = moments.units(F.col(amount), scale)
    filled = F.coalesce(u, F.lit(0).cast(moments.UNITS))
    return (
        bought.where(has_text(F.col(key)))
        .select(key, date, category, u.isNull().alias("_missing"), filled.alias("_u"))
        .groupBy(key, date, category)
        .agg(
            F.count(F.lit(1)).alias("n"),
            moments.sum_units(F.col("_u")).alias("s"),
            moments.sum_squares(F.col("_u")).alias("ss"),
            F.count_if("_missing").alias("missing"),
        )
        .where("n > 0 OR s IS NULL OR ss IS NULL OR missing < 0")
    )


def _placed(date: str, category: str) -> Column:
    return F.col(date).isNotNull() & has_text(F.col(category))


def _with_length(
    cells: DataFrame,
    key: str,
    totals: DataFrame | None,
    threshold: int,
    short: int,
    long: int,
    how: str = "inner",
    workspace: Workspace | None = None,
) -> DataFrame:
    if totals is None:
        totals = cells.groupBy(key).agg(F.sum("n").alias("n"))
    lengths = totals.select(key, window_length(F.col("n"), threshold, short, long).alias("_length"))
    return lookup_join(cells, lengths, key, how, workspace)


def window_rules(date: str, category: str) -> dict[str, Column]:
    """Rows that the window job used and skipped, counted on cells with their ``_length``."""
    placed, dated, known = has_text(F.col(category)), F.col(date).isNotNull(), F.col("_length").isNotNull()
    used = placed & dated & known
    return {
        "BOUGHT_RECORDS": F.when(used, F.col("n")),
        "MISSING_AMOUNT": F.when(used, F.col("missing")),
        "BUCKET_EMISSIONS": F.when(used, F.col("n") * F.col("_length")),
        "INVALID_DATE": F.when(placed & ~dated, F.col("n")),
        "STATE_COUNT_MISSING": F.when(placed & dated & ~known, F.col("n")),
    }


def _block(day: Column, block_days: int) -> Column:
    return F.floor(day / F.lit(float(block_days))).cast("int")


def trailing_buckets(
    bought: DataFrame,
    key: str = "state",
    date: str = "order_date",
    category: str = "size",
    amount: str = "amount",
    threshold: int = THRESHOLD,
    short: int = SHORT_DAYS,
    long: int = LONG_DAYS,
    totals: DataFrame | None = None,
    scale: int = moments.DEFAULT_SCALE,
    block_days: int = BLOCK_DAYS,
    workspace: Workspace | None = None,
    counters: Observation | None = None,
) -> DataFrame:
    """Count and moments per (key, window_date, category), over the ``length`` days before each window date.

    The window date itself is left out, window dates after the last day of data are kept, and dates with nothing in
    reach have no row. ``totals`` (key, n) sets the lengths if given, and drops keys that it lacks; else the counts
    come from ``bought``, in the same pass. ``counters`` gets the ``window_rules`` of this run.

    The rows are reduced to daily cells first. These are shuffled by (key, block of days, category), a cell to the one or
    two blocks that its window dates fall in, so that a busy key is split by time and category. There a cell is two
    events: its moments come in on its first window date and go out behind its last one. Running sums of the events, exact
    in decimals, are the windows between an event and the next, and only these spread to single dates.
    """
    cells = staged(daily_cells(bought, key, date, category, amount, scale), workspace, "cells")
    how = "inner" if counters is None else "left"
    sized = _with_length(cells, key, totals, threshold, short, long, how, workspace)
    if counters is not None:
        sized = sized.observe(counters, *sums_of(window_rules(date, category))).where(F.col("_length").isNotNull())
    # With the count in the condition, it stays above the cells: below, they would no longer be those of the totals.
    sized = sized.where(F.when(_placed(date, category), F.col("n")) > 0)
    first = F.unix_date(date) + 1
    last = F.unix_date(date) + F.col("_length")
    start, stop = F.col("block") * block_days, (F.col("block") + 1) * block_days
    names = ("n", "s", "ss")
    spread = (
        sized.withColumn("block", F.explode(F.sequence(_block(first, block_days), _block(last, block_days))))
        .select(key, "block", category, F.greatest(first, start).alias("_in"), (last + 1).alias("_out"), *names)
        .repartition(key, "block", category)
    )
    comes = F.struct(F.col("_in").alias("_day"), *(F.col(name).alias(name) for name in names))
    goes = F.struct(F.col("_out").alias("_day"), *((-F.col(name)).alias(name) for name in names))
    events = F.when(F.col("_out") < stop, F.array(comes, goes)).otherwise(F.array(comes))
    own = Window.partitionBy(key, "block", category).orderBy("_day")
    upto = own.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # Of several events on one day, only the last has a later day next, and its sums hold them all.
    until = F.coalesce(F.lead("_day").over(own), stop)
    running = spread.select(key, "block", category, F.inline(events)).select(
        key, category, "_day", until.alias("_until"), *(F.sum(name).over(upto).alias(name) for name in names)
    )
    return (
        running.where("n > 0 AND _until > _day")
        .select(key, category, *names, F.explode(F.sequence(F.col("_day"), F.col("_until") - 1)).alias("_day"))
        .select(
            key,
            F.date_from_unix_date("_day").alias("window_date"),
            category,
            "n",
            F.col("s").cast(moments.SUMS).alias("s"),
            F.col("ss").cast(moments.SUMS).alias("ss"),
        )
    )


def pick_winners(
    buckets: DataFrame, key: str = "state", category: str = "size", scale: int = moments.DEFAULT_SCALE
) -> DataFrame:
    """The most frequent category per (key, window_date); ties go to the lower variance, then to the lower name.

    The best is a minimum, so it is merged from partial ones and no task holds all categories of a window. The
    tie-break compares whole numbers; the variance is reported as double.
    """
    n, s, ss = F.col("n"), F.col("s"), F.col("ss")
    place = F.struct((-n).alias("minus"), moments.spread(n, s, ss).alias("spread"), category, "n", "s", "ss")
    best = buckets.groupBy(key, "window_date").agg(F.min(place).alias("best")).select(key, "window_date", "best.*")
    return best.select(
        key,
        "window_date",
        F.col(category).alias(f"most_bought_{category}"),
        n.alias("frequency"),
        moments.variance(n, s, ss, scale).alias("population_variance"),
    )


def trailing_window_winner(
    bought: DataFrame,
    key: str = "state",
    date: str = "order_date",
    category: str = "size",
    amount: str = "amount",
    threshold: int = THRESHOLD,
    short: int = SHORT_DAYS,
    long: int = LONG_DAYS,
    totals: DataFrame | None = None,
    scale: int = moments.DEFAULT_SCALE,
    workspace: Workspace | None = None,
    counters: Observation | None = None,
) -> DataFrame:
    """For each key and date: the category bought most in the days before. See ``trailing_buckets``."""
    buckets = trailing_buckets(
        bought, key, date, category, amount, threshold, short, long, totals, scale,
        workspace=workspace, counters=counters,
    )
    return pick_winners(buckets, key, category, scale)


def window_quality(
    bought: DataFrame,
    key: str = "state",
    date: str = "order_date",
    category: str = "size",
    amount: str = "amount",
    threshold: int = THRESHOLD,
    short: int = SHORT_DAYS,
    long: int = LONG_DAYS,
    totals: DataFrame | None = None,
    scale: int = moments.DEFAULT_SCALE,
    workspace: Workspace | None = None,
) -> DataFrame:
    """What the window job used and skipped, as rows (rule, rows). A run with ``counters`` tells the same by the way."""
    cells = staged(daily_cells(bought, key, date, category, amount, scale), workspace, "cells")
    sized = _with_length(cells, key, totals, threshold, short, long, "left", workspace)
    return quality_profile(sized, window_rules(date, category))
