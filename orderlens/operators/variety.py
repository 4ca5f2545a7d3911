"""How many different items each style offers, and the median over styles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from orderlens.functions.text import BIG_SIZE_RANK, has_text, size_rank
from orderlens.operators.checks import sums_of
from orderlens.operators.lookup import Workspace, lookup_join


def is_big_size(size: Column, min_rank: int = BIG_SIZE_RANK) -> Column:
    """XXL or bigger; unknown sizes are not."""
    return F.coalesce(size_rank(size) >= min_rank, F.lit(False))


def qualifying_styles(records: DataFrame, style: str = "style", qualifies: Column | None = None) -> DataFrame:
    """Styles with at least one qualifying row anywhere, whatever that row's date, group or item."""
    rule = is_big_size(F.col("size")) if qualifies is None else qualifies
    return records.where(has_text(F.col(style)) & rule).select(style).distinct()


def style_variety(
    records: DataFrame,
    period: str = "month",
    group: str = "state",
    style: str = "style",
    item: str = "sku",
    qualifies: Column | None = None,
) -> DataFrame:
    """Distinct items per (period, group, style), with a flag for styles seen with a qualifying row there.

    Items are made distinct first, then counted, so no task ever holds a group's items. A row lacking its period,
    group or item is not counted but can still qualify its style. ``rows``, ``complete_rows`` and ``qualifying_rows`` say
    how many there were, how many of them had all fields, and how many qualified.
    """
    rule = F.lit(True) if qualifies is None else F.coalesce(qualifies, F.lit(False))
    complete = F.col(period).isNotNull() & has_text(F.col(group)) & has_text(F.col(item))
    items = (
        records.where(has_text(F.col(style)))
        .select(period, group, style, item, rule.alias("_qualifies"))
        .groupBy(period, group, style, item)
        .agg(F.count(F.lit(1)).alias("_n"), F.count_if("_qualifies").alias("_q"))
    )
    return items.groupBy(period, group, style).agg(
        F.count_if(complete).alias("variety"),
        (F.sum("_q") > 0).alias("qualifies"),
        F.sum("_n").alias("rows"),
        F.coalesce(F.sum(F.when(complete, F.col("_n"))), F.lit(0)).alias("complete_rows"),
        F.sum("_q").alias("qualifying_rows"),
    )


def variety_rules(period: str, valid: Column) -> dict[str, Column]:
    """Rows that the variety medians used and skipped, counted on ``style_variety``. ``valid`` marks allowed styles."""
    dated = F.col(period).isNotNull()
    return {
        "QUALIFYING_XXL_ROWS": F.col("qualifying_rows"),
        "BAD_DATE_ROWS": F.when(valid & ~dated, F.col("rows")),
        "MISSING_GROUP_FIELDS": F.when(valid & dated, F.col("rows") - F.col("complete_rows")),
        "QUALIFIED_STYLE_ROWS": F.when(valid & dated, F.col("complete_rows")),
    }


def qualified_variety(
    records: DataFrame,
    period: str = "month",
    group: str = "state",
    style: str = "style",
    item: str = "sku",
    qualifies: Column | None = None,
) -> DataFrame:
    """``style_variety`` with ``valid``: whether the style has a qualifying row anywhere.

    Found in the counts themselves, by a window over a style's periods and groups, without another pass over ``records``.
    """
    rule = is_big_size(F.col("size")) if qualifies is None else qualifies
    counted = style_variety(records, period, group, style, item, rule)
    return counted.withColumn("valid", F.max("qualifies").over(Window.partitionBy(style)))


def median_variety(
    records: DataFrame,
    period: str = "month",
    group: str = "state",
    style: str = "style",
    item: str = "sku",
    qualifies: Column | None = None,
    styles: DataFrame | None = None,
    workspace: Workspace | None = None,
    counters: Observation | None = None,
) -> DataFrame:
    """Median, over the styles allowed, of the distinct items per (period, group).

    The styles are those in ``styles``, or those with a row that meets ``qualifies`` (default: size XXL or bigger), which
    takes one read of ``records``. Given styles filter the rows before the first shuffle if they were measured and can be
    broadcast; otherwise the counts, which are far fewer than the rows. ``counters`` gets the ``variety_rules`` of this
    run; it needs ``styles`` to be left out. The median is merged from partial counts per variety.
    """
    if styles is None:
        found = qualified_variety(records, period, group, style, item, qualifies)
        if counters is not None:
            found = found.observe(counters, *sums_of(variety_rules(period, F.col("valid"))))
        kept = found.where("valid")
    elif counters is not None:
        raise ValueError("counters are of the run that finds the styles")
    else:
        listed = styles.select(style).distinct()
        allowed = listed if workspace is None else workspace.lookup(listed, "styles")
        if workspace is not None and allowed.fits():
            kept = style_variety(lookup_join(records, allowed, style, "left_semi"), period, group, style, item)
        else:
            kept = lookup_join(style_variety(records, period, group, style, item), allowed, style, "left_semi")
    return kept.where("variety > 0").groupBy(period, group).agg(F.median("variety").alias("median_variety"))
