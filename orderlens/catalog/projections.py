"""Row-level views, filters and scalar functions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlens.catalog import base
from orderlens.catalog.base import Entry, with_, with_raw
from orderlens.catalog.scans import NORMALISED
from orderlens.functions import parsing, text
from orderlens.operators import promotions as promo
from orderlens.operators import windows
from orderlens.operators.variety import is_big_size
from orderlens.plans import records
from orderlens.sources.sample import sales


def normalised_projection(spark: SparkSession, folder: str) -> DataFrame:
    return records.promotion_records(base.raw(spark, folder))


def derived_columns(spark: SparkSession, folder: str) -> DataFrame:
    rows = records.percentile_records(base.raw(spark, folder))
    return rows.select("SKU", "order_date", "year_month", "amount_value", "promotion_count")


def bought_filter(spark: SparkSession, folder: str) -> DataFrame:
    return records.bought_records(base.raw(spark, folder))


def nonempty_key_filter(spark: SparkSession, folder: str) -> DataFrame:
    """Platform records lose their state and cancelled ones their size, then rows missing either go."""
    rows = sales(spark, folder).select(
        "order_id",
        F.when(F.col("fulfilment") == "Platform", "").otherwise(F.col("state")).alias("state"),
        F.when(F.col("status") != "Cancelled", F.col("size")).alias("size"),
    )
    return rows.where(text.has_text(F.col("state")) & text.has_text(F.col("size")))


def size_threshold_filter(spark: SparkSession, folder: str) -> DataFrame:
    return sales(spark, folder).where(is_big_size(F.col("size"))).select("order_id", "style", "sku", "size")


def complete_group_fields(spark: SparkSession, folder: str) -> DataFrame:
    """Rows with a style, state and SKU, where platform records have a blank style and cancelled ones a blank SKU."""
    rows = records.variety_records(
        base.raw(spark, folder)
        .withColumn("Style", F.when(F.col("Fulfilment") == "Platform", "  ").otherwise(F.col("Style")))
        .withColumn("SKU", F.when(F.col("Status") == "Cancelled", "\t").otherwise(F.col("SKU")))
    )
    return rows.where(text.has_text(F.col("state")) & text.has_text(F.col("style")) & text.has_text(F.col("sku")))


def known_orders(spark: SparkSession, folder: str) -> DataFrame:
    """Expedited records have no order id and drop out; cancelled ones have a blank id and stay."""
    order_id = F.when(F.col("ship-service-level") == "Standard", F.col("Order ID"))
    order_id = F.when(F.col("Status") == "Cancelled", "   ").otherwise(order_id)
    rows = records.promotion_records(base.raw(spark, folder).withColumn("Order ID", order_id))
    return rows.select("order_id", "order_date", "city", "amount")


def promotion_appearances(spark: SparkSession, folder: str) -> DataFrame:
    return promo.promotion_appearances(sales(spark, folder))


def merchant_shipped_filter(spark: SparkSession, folder: str) -> DataFrame:
    rows = base.lowered(spark, folder).where(F.col("merchant_shipped") & F.col("amount").isNotNull())
    return rows.select("order_id", "state", "amount")


def cancelled_standard_filter(spark: SparkSession, folder: str) -> DataFrame:
    rows = base.lowered(spark, folder).where(F.col("cancelled_standard") & F.col("city").isNotNull())
    return rows.select("order_id", "city", "state", "amount")


def text_functions(spark: SparkSession, folder: str) -> DataFrame:
    """Records' texts wrapped in blanks, tabs and odd case, and cleaned again."""
    messy = F.concat(F.lit("\t "), F.lower("status"), F.lit(" \t  by  "), "state", F.lit(" \n"))
    rows = sales(spark, folder).select("order_id", "status", messy.alias("messy"), F.col("city").alias("city"))
    m = F.col("messy")
    return rows.select(
        "order_id",
        F.trim(F.concat(F.lit("  "), "status", F.lit(" "))).alias("trimmed"),
        text.strip(m).alias("stripped"),
        text.strip_upper(m).alias("upper_text"),
        text.squeeze_upper(m).alias("squeezed"),
        F.lower("status").contains("shipped").alias("mentions_shipped"),
        F.regexp_replace(F.concat(F.lit('"'), "city", F.lit('"')), '^"|"$', "").alias("unquoted"),
        F.length(m).alias("text_length"),
    )


def size_ranks(spark: SparkSession, folder: str) -> DataFrame:
    """Ranks of the sizes as they are, spaced out, and grown from the part's number: 1XL .. 50XL, X..L of any length."""
    part = spark.read.parquet(f"{folder}/part.parquet").select("p_partkey", "p_size")
    number = F.col("p_size")
    spelled = (
        F.when(F.col("p_partkey") % 2 == 0, F.concat(number.cast("string"), F.lit("xl")))
        .when(number > 40, F.concat(F.lit(" "), F.repeat(F.lit("x "), (number - 40).cast("int")), F.lit("l ")))
        .when(number > 30, "M")
        .when(number > 20, "xs")
        .otherwise("Free")
    )
    return part.select("p_partkey", spelled.alias("size"), text.size_rank(spelled).alias("size_rank"))


def token_functions(spark: SparkSession, folder: str) -> DataFrame:
    ids = F.col("promotion_ids")
    once = text.distinct_tokens(ids)
    return sales(spark, folder).select(
        "order_id",
        "promotion_ids",
        F.array_join(text.tokens(ids), "|").alias("kept"),
        F.array_join(F.sort_array(once), "|").alias("sorted_once"),
        F.element_at(F.sort_array(once), 1).alias("first_token"),
        F.size(once).alias("distinct_count"),
        text.token_count(ids).alias("token_count"),
        text.token_count(F.concat(F.lit(" | "), F.translate(ids, ",", "|")), "|").alias("piped_count"),
    )


def date_functions(spark: SparkSession, folder: str) -> DataFrame:
    """Dates written MM-dd-yy and read back; cancelled records get a day that does not exist."""
    written = F.date_format("order_date", parsing.DATE_PATTERN)
    written = F.when(F.col("status") == "Cancelled", "02-30-22").otherwise(written)
    parsed = parsing.parse_date(written)
    # Day 31 of every month, which the lenient rule takes for the month's last day.
    late = parsing.parse_date_leniently(F.date_format("order_date", "MM-31-yy"))
    return sales(spark, folder).select(
        "order_id",
        parsed.alias("parsed"),
        late.alias("month_end"),
        parsing.month_of(parsed).alias("month"),
        F.date_add(parsed, 10).alias("ten_days_on"),
        F.datediff(F.lit("2002-01-01").cast("date"), parsed).alias("days_to_2002"),
    )


def numeric_functions(spark: SparkSession, folder: str) -> DataFrame:
    """Tolerant parsing of quantities, some of them blank or words, and the arithmetic used on them."""
    written = F.when(F.col("status") == "Cancelled", "none").when(F.col("qty") > 40, " ")
    qty = parsing.parse_double(written.otherwise(F.col("qty").cast("string")))
    filled = F.coalesce(qty, F.lit(0.0))
    return sales(spark, folder).select(
        "order_id",
        qty.alias("qty"),
        F.abs(filled - 25.0).alias("from_25"),
        F.floor(filled / 8.0).alias("eighths_down"),
        F.ceil(filled / 8.0).alias("eighths_up"),
        (filled * 2.0 + 1.0).cast("int").alias("doubled"),
        F.when(filled > 20, "many").otherwise("few").alias("amount_class"),
        qty.isNull().alias("unparsed"),
    )


def window_lengths(spark: SparkSession, folder: str) -> DataFrame:
    counts = windows.key_counts(base.bought(spark, folder))
    return counts.withColumn("length", windows.window_length(F.col("n"), base.TEST_THRESHOLD))


def monthly_buckets(spark: SparkSession, folder: str) -> DataFrame:
    return base.monthly(spark, folder).groupBy("month").agg(F.count(F.lit(1)).alias("records"))


BIG = "size IN ('XXL', '3XL')"
T = base.TOKENS_SQL

ENTRIES = {
    "normalised_projection": Entry(normalised_projection, with_raw(select=NORMALISED)),
    "derived_columns": Entry(
        derived_columns,
        with_raw(
            select=f"""SELECT sku AS "SKU", order_date, strftime(order_date, '%Y-%m') AS year_month,
  amount AS amount_value, CAST(len({T}) AS INTEGER) AS promotion_count FROM sales"""
        ),
    ),
    "bought_filter": Entry(
        bought_filter,
        with_raw(
            select="""SELECT upper(state) AS state, order_date, size, amount FROM sales
WHERE lower(status) LIKE '%shipped%' AND qty <> 0"""
        ),
    ),
    "nonempty_key_filter": Entry(
        nonempty_key_filter,
        with_(select="SELECT order_id, state, size FROM sales WHERE fulfilment <> 'Platform' AND status <> 'Cancelled'"),
    ),
    "size_threshold_filter": Entry(
        size_threshold_filter, with_(select=f"SELECT order_id, style, sku, size FROM sales WHERE {BIG}")
    ),
    "complete_group_fields": Entry(
        complete_group_fields,
        with_raw(
            select="""SELECT strftime(order_date, '%Y-%m') AS month, upper(state) AS state, upper(style) AS style, sku, size
FROM sales WHERE fulfilment <> 'Platform' AND status <> 'Cancelled'"""
        ),
    ),
    "known_orders": Entry(
        known_orders,
        with_raw(
            select="""SELECT CASE WHEN status = 'Cancelled' THEN '' ELSE order_id END AS order_id, order_date,
  upper(city) AS city, amount FROM sales WHERE status = 'Cancelled' OR service_level = 'Standard'"""
        ),
    ),
    "promotion_appearances": Entry(
        promotion_appearances, with_(base.APPEARANCES_SQL, select="SELECT * FROM appearances")
    ),
    "merchant_shipped_filter": Entry(
        merchant_shipped_filter,
        with_(
            select="""SELECT order_id, state, amount FROM sales
WHERE fulfilment = 'Merchant' AND courier_status = 'Shipped' AND amount IS NOT NULL"""
        ),
    ),
    "cancelled_standard_filter": Entry(
        cancelled_standard_filter,
        with_(
            select="""SELECT order_id, city, state, amount FROM sales
WHERE service_level = 'Standard' AND status = 'Cancelled' AND city IS NOT NULL"""
        ),
    ),
    "text_functions": Entry(
        text_functions,
        with_(
            select=r"""SELECT order_id, status AS trimmed, lower(status) || ' ' || chr(9) || '  by  ' || state AS stripped,
  upper(lower(status) || ' ' || chr(9) || '  by  ' || state) AS upper_text,
  upper(lower(status) || ' by ' || state) AS squeezed, lower(status) LIKE '%shipped%' AS mentions_shipped,
  city AS unquoted, CAST(length(status) + length(state) + 12 AS INTEGER) AS text_length FROM sales"""
        ),
    ),
    "size_ranks": Entry(
        size_ranks,
        """WITH spelled AS (
  SELECT p_partkey, CASE WHEN p_partkey % 2 = 0 THEN CAST(p_size AS VARCHAR) || 'xl'
    WHEN p_size > 40 THEN ' ' || repeat('x ', CAST(p_size - 40 AS INT)) || 'l '
    WHEN p_size > 30 THEN 'M' WHEN p_size > 20 THEN 'xs' ELSE 'Free' END AS size, p_size FROM part)
SELECT p_partkey, size, CAST(CASE WHEN p_partkey % 2 = 0 AND p_size BETWEEN 2 AND 9 THEN p_size + 4
  WHEN p_partkey % 2 = 0 AND p_size >= 20 THEN p_size + 4 WHEN p_partkey % 2 = 0 THEN NULL
  WHEN p_size > 40 THEN p_size - 36 WHEN p_size > 30 THEN 3 WHEN p_size > 20 THEN 1 END AS INTEGER) AS size_rank
FROM spelled""",
    ),
    "token_functions": Entry(
        token_functions,
        with_(
            select=f"""SELECT order_id, promotion_ids, array_to_string({T}, '|') AS kept,
  array_to_string(list_sort(list_distinct({T})), '|') AS sorted_once,
  list_sort(list_distinct({T}))[1] AS first_token, CAST(len(list_distinct({T})) AS INTEGER) AS distinct_count,
  CAST(len({T}) AS INTEGER) AS token_count, CAST(len({T}) AS INTEGER) AS piped_count FROM sales"""
        ),
    ),
    "date_functions": Entry(
        date_functions,
        with_raw(
            "parsed AS (SELECT order_id, order_date, CASE WHEN status <> 'Cancelled' THEN order_date END AS parsed FROM sales)",
            select="""SELECT order_id, parsed, last_day(order_date) AS month_end, strftime(parsed, '%Y-%m') AS month,
  CAST(parsed + 10 AS DATE) AS ten_days_on,
  CAST(date_diff('day', parsed, DATE '2002-01-01') AS INTEGER) AS days_to_2002 FROM parsed""",
        ),
    ),
    "numeric_functions": Entry(
        numeric_functions,
        with_(
            "parsed AS (SELECT order_id, CASE WHEN status <> 'Cancelled' AND qty <= 40 THEN qty END AS q FROM sales)",
            select="""SELECT order_id, q AS qty, abs(coalesce(q, 0) - 25.0) AS from_25,
  CAST(floor(coalesce(q, 0) / 8.0) AS BIGINT) AS eighths_down, CAST(ceil(coalesce(q, 0) / 8.0) AS BIGINT) AS eighths_up,
  CAST(coalesce(q, 0) * 2 + 1 AS INTEGER) AS doubled, CASE WHEN q > 20 THEN 'many' ELSE 'few' END AS amount_class,
  q IS NULL AS unparsed FROM parsed""",
        ),
    ),
    "window_lengths": Entry(
        window_lengths,
        with_(
            base.BOUGHT_SQL,
            base.COUNTS_SQL,
            select=f"""SELECT state, total AS n, CAST(CASE WHEN total > {base.TEST_THRESHOLD} THEN 5 ELSE 10 END AS INTEGER) AS length
FROM counts""",
        ),
    ),
    "monthly_buckets": Entry(
        monthly_buckets,
        with_(select="SELECT strftime(order_date, '%Y-%m') AS month, count(*) AS records FROM sales GROUP BY 1"),
    ),
}
