"""Sources and sinks: sales records go out to files in the shared folder and come back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlens.catalog import base
from orderlens.catalog.base import Entry, with_, with_raw
from orderlens.operators.comparison import timing_summary
from orderlens.operators.percentiles import approx_thresholds, exact_thresholds
from orderlens.operators.windows import trailing_window_winner
from orderlens.plans.records import percentile_records, promotion_records
from orderlens.plans.workloads import percentages_of
from orderlens.sources import readers, writers
from orderlens.sources.schema import SALES_COLUMNS

CSV_OPTIONS = {"escape": '"'}


def _written_csv(spark: SparkSession, folder: str) -> str:
    path = base.scratch_path(spark, "sales-csv")
    base.raw(spark, folder).write.option("header", True).option("compression", "snappy").options(**CSV_OPTIONS).csv(path)
    return path


def csv_permissive_scan(spark: SparkSession, folder: str) -> DataFrame:
    return promotion_records(readers.read_sales(spark, _written_csv(spark, folder)))


def csv_strict_scan(spark: SparkSession, folder: str) -> DataFrame:
    rows = percentile_records(readers.read_sales_strict(spark, _written_csv(spark, folder)))
    return rows.select("SKU", "order_date", "year_month", "amount_value", "promotion_count")


def _line(columns: list[Column]) -> Column:
    return F.to_csv(F.struct(*columns), CSV_OPTIONS)


def _written_lines(spark: SparkSession, folder: str) -> str:
    """Lines with trouble in them: rows without an amount are cut short, rows of free size carry one field too many,
    the category holds quotes and a comma, and one header line stands in for each style.
    """
    rows = base.raw(spark, folder).withColumn("Category", F.concat(F.lit('say "'), "Style", F.lit('", twice')))
    fields = [F.col(f"`{name}`") for name in SALES_COLUMNS]
    short, long = _line(fields[:20]), _line([*fields, F.lit("x").alias("extra")])
    text = F.when(F.col("Amount").isNull(), short).when(F.col("Size") == "Free", long).otherwise(_line(fields))
    header = F.lit(",".join(SALES_COLUMNS))
    lines = rows.select(text.alias("value")).unionByName(rows.select("Style").distinct().select(header.alias("value")))
    path = base.scratch_path(spark, "sales-lines")
    lines.write.option("compression", "snappy").text(path)
    return path


def csv_width_checked_scan(spark: SparkSession, folder: str) -> DataFrame:
    rows = readers.read_sales_rows(spark, _written_lines(spark, folder))
    return rows.select("Date", "Category", "Size", "SKU")


def csv_quote_keeping_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Fields with quotes, commas and backslashes, whose doubled quotes stay as they are."""
    rows = base.raw(spark, folder)
    category = F.concat(F.lit('"12"" '), F.col("Style"), F.lit(', red"'))
    fields = {"Category": category, "ASIN": F.concat(F.lit('"abc'), F.lit("\\"), F.lit('"')), "Courier Status": F.lit('a "b" c')}
    plain = [fields.get(name, F.coalesce(F.col(f"`{name}`"), F.lit(""))) for name in SALES_COLUMNS[:-4]]
    # Promotion lists hold commas, so they are quoted; the last fields are short texts.
    promotions = F.concat(F.lit('"'), F.col("promotion-ids"), F.lit('"'))
    line = F.concat_ws(",", *plain, promotions, F.lit("x"), F.lit(" y "), F.lit(""))
    path = base.scratch_path(spark, "quoted-lines")
    header = spark.range(1).select(F.lit(",".join(SALES_COLUMNS)).alias("value"))
    rows.select(line.alias("value")).unionByName(header).write.option("compression", "snappy").text(path)
    back = readers.read_sales_rows(spark, path, unescape_quotes=False)
    kept = {"order_id": "Order ID", "category": "Category", "asin": "ASIN", "courier": "Courier Status", "promotions": "promotion-ids"}
    return back.select(*(F.col(f"`{name}`").alias(alias) for alias, name in kept.items()))


def csv_line_quality(spark: SparkSession, folder: str) -> DataFrame:
    return readers.line_quality(readers.read_sales_lines(spark, _written_lines(spark, folder)))


def parquet_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    path = base.scratch_path(spark, "percentages")
    writers.write_results(percentages_of(base.lowered(spark, folder)), path)
    return readers.read_results(spark, path)


def methods_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    rows = base.prepared(spark, folder)
    path = base.scratch_path(spark, "thresholds")
    writers.write_methods(approx_thresholds(rows, base.GROUP), exact_thresholds(rows, base.GROUP), path)
    levels = [F.round(name, 9).alias(name) for name in ("p80", "p90")]
    return readers.read_results(spark, path).select(*base.GROUP, "order_count", *levels, "method")


def report_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    winners = trailing_window_winner(base.bought(spark, folder), threshold=base.TEST_THRESHOLD, scale=2)
    path = base.scratch_path(spark, "winners")
    writers.write_report(winners, path, ["state", "window_date"])
    schema = "state string, window_date date, most_bought_size string, frequency bigint, population_variance double"
    back = spark.read.schema(schema).option("header", True).option("mode", "FAILFAST").csv(path)
    return back.withColumn("population_variance", F.round("population_variance", 4))


def bounded_display(spark: SparkSession, folder: str) -> DataFrame:
    return base.monthly(spark, folder).groupBy("month", "state").count().orderBy("month", "state").limit(50)


def measurements(spark: SparkSession, folder: str) -> DataFrame:
    """Timings in the shape of (method, seconds): the events' type and value."""
    events = spark.read.parquet(f"{folder}/events.parquet")
    return events.select(F.col("event_type").alias("method"), F.col("value").alias("seconds"))


def timings(spark: SparkSession, folder: str) -> DataFrame:
    rounded = [F.round(name, 6).alias(name) for name in ("mean_seconds", "stddev_seconds")]
    return timing_summary(measurements(spark, folder)).select("method", "measured_runs", *rounded)


NORMALISED = """SELECT order_id, order_date, upper(city) AS city, upper(state) AS state, amount, promotion_ids,
  fulfilment = 'Merchant' AND courier_status = 'Shipped' AS merchant_shipped,
  service_level = 'Standard' AND status = 'Cancelled' AS cancelled_standard FROM sales"""

WIDE = """SELECT strftime(order_date, '%m-%d-%y') AS "Date", 'say "' || style || '", twice' AS "Category",
  size AS "Size", sku AS "SKU" FROM sales WHERE amount IS NOT NULL AND size <> 'Free'"""

ENTRIES = {
    "csv_permissive_scan": Entry(csv_permissive_scan, with_raw(select=NORMALISED)),
    "csv_strict_scan": Entry(
        csv_strict_scan,
        with_raw(
            base.PREPARED_SQL,
            select="""SELECT sku AS "SKU", order_date, strftime(order_date, '%Y-%m') AS year_month,
  amount AS amount_value, CAST(len("""
            + base.TOKENS_SQL
            + """) AS INTEGER) AS promotion_count FROM sales""",
        ),
    ),
    "csv_width_checked_scan": Entry(csv_width_checked_scan, with_(select=WIDE)),
    "csv_quote_keeping_scan": Entry(
        csv_quote_keeping_scan,
        with_(
            select=r"""SELECT order_id, '12"" ' || style || ', red' AS category, 'abc\' AS asin, 'a "b" c' AS courier,
  promotion_ids AS promotions FROM sales"""
        ),
    ),
    "csv_line_quality": Entry(
        csv_line_quality,
        with_(
            select="""SELECT 'BAD_CSV_ROWS' AS rule, count(*) FILTER (amount IS NULL OR size = 'Free') AS rows
FROM sales
UNION ALL SELECT 'HEADER_ROWS', count(DISTINCT style) FROM sales"""
        ),
    ),
    "parquet_round_trip": Entry(parquet_round_trip, base.PERCENTAGE_SQL),
    "methods_round_trip": Entry(
        methods_round_trip,
        with_(
            base.PREPARED_SQL,
            base.thresholds_sql("a", "quantile_disc"),
            base.thresholds_sql("e", "quantile_cont"),
            select="""SELECT style, year_month, order_count, round(p80, 9) AS p80, round(p90, 9) AS p90,
  'approx' AS method FROM a
UNION ALL SELECT style, year_month, order_count, round(p80, 9), round(p90, 9), 'exact' FROM e""",
        ),
    ),
    "report_round_trip": Entry(
        report_round_trip,
        with_(
            base.BOUGHT_SQL, base.COUNTS_SQL, base.BUCKETS_SQL, base.WINNERS_SQL, select="SELECT * FROM winners"
        ),
    ),
    "bounded_display": Entry(
        bounded_display,
        with_(
            select="""SELECT strftime(order_date, '%Y-%m') AS month, state, count(*) AS count FROM sales
GROUP BY 1, 2 ORDER BY 1, 2 LIMIT 50"""
        ),
    ),
    "timing_summary": Entry(
        timings,
        """SELECT event_type AS method, count(*) AS measured_runs, round(avg(value), 6) AS mean_seconds,
  round(stddev_samp(value), 6) AS stddev_seconds FROM events GROUP BY event_type""",
    ),
}
