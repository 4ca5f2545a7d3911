"""What a catalog entry is, and the record views that entries share."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlens.functions.parsing import month_of
from orderlens.functions.text import token_count
from orderlens.operators.lookup import Workspace
from orderlens.operators.promotions import is_cancelled_standard, is_merchant_shipped
from orderlens.operators.windows import is_bought
from orderlens.sources.sample import as_raw, sales

# No state of the small test tables reaches the default of 10,000 bought rows; about half of them exceed this.
TEST_THRESHOLD = 1600
GROUP = ("style", "year_month")


@dataclass(frozen=True)
class Entry:
    """A query on the test tables and, where SQL can state it, the SQL that gives the same rows."""

    build: Callable[[SparkSession, str], DataFrame]
    sql: str | None = None


_scratch: list[str] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path for the entries that write and read back: in the session's shared folder, or in a temporary one on a
    local master, which goes when Python ends.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors can reach")
        if not _scratch:
            _scratch.append(tempfile.mkdtemp(prefix="orderlens-"))
            atexit.register(shutil.rmtree, _scratch[0], ignore_errors=True)
        folder = _scratch[0]
    return f"{folder.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def workspace(spark: SparkSession) -> Workspace:
    """A workspace for an entry whose rows are computed after it returns, so it stays open; its tables go with the folder
    of ``scratch_path``.
    """
    return Workspace(spark, scratch_path(spark, "workspace"))


def bought(spark: SparkSession, folder: str) -> DataFrame:
    records = sales(spark, folder)
    return records.where(is_bought(F.col("status"), F.col("qty")))


def lowered(spark: SparkSession, folder: str) -> DataFrame:
    """Records with lower-case texts, and whether each takes part in an average or in a share."""
    names = ("status", "fulfilment", "service_level", "courier_status")
    rows = sales(spark, folder).withColumns({name: F.lower(name) for name in names})
    return rows.withColumns(
        {
            "merchant_shipped": is_merchant_shipped(F.col("fulfilment"), F.col("courier_status")),
            "cancelled_standard": is_cancelled_standard(F.col("status"), F.col("service_level")),
        }
    )


def monthly(spark: SparkSession, folder: str) -> DataFrame:
    return sales(spark, folder).withColumn("month", month_of(F.col("order_date")))


def prepared(spark: SparkSession, folder: str) -> DataFrame:
    """Style, month, promotion count and amount: the thresholds' input, by style to have groups of some size."""
    return sales(spark, folder).select(
        "style",
        month_of(F.col("order_date")).alias("year_month"),
        token_count(F.col("promotion_ids")).alias("promotion_count"),
        "amount",
    )


def raw(spark: SparkSession, folder: str) -> DataFrame:
    return as_raw(sales(spark, folder))


SALES_SQL = """sales AS (
  SELECT CAST(l_orderkey AS VARCHAR) AS order_id, CAST(l_shipdate AS DATE) AS order_date,
    CASE l_returnflag WHEN 'A' THEN 'Shipped' WHEN 'N' THEN 'Shipped - Delivered to Buyer' ELSE 'Cancelled' END
      AS status,
    CASE l_linestatus WHEN 'O' THEN 'Merchant' ELSE 'Platform' END AS fulfilment,
    CASE WHEN o_orderpriority IN ('4-NOT SPECIFIED', '5-LOW') THEN 'Standard' ELSE 'Expedited' END AS service_level,
    CASE WHEN l_returnflag = 'R' THEN 'Cancelled' WHEN o_orderstatus = 'P' THEN 'Unshipped' ELSE 'Shipped' END
      AS courier_status,
    c_mktsegment || '-' || CAST(n_regionkey AS VARCHAR) AS city, n_name AS state, p_brand AS style,
    'P' || CAST(p_partkey AS VARCHAR) AS sku,
    CASE WHEN p_size = 50 THEN 'XXL' WHEN p_size = 49 THEN '3XL' WHEN p_size > 40 THEN 'Free'
      WHEN p_size > 30 THEN 'XL' WHEN p_size > 20 THEN 'L' WHEN p_size > 10 THEN 'M' ELSE 'S' END AS size,
    l_quantity AS qty, CASE WHEN l_tax = 0.08 THEN NULL ELSE l_extendedprice END AS amount,
    p_brand || '-' || strftime(l_shipdate, '%Y-%m') || ',,' || p_type || '-' || strftime(l_shipdate, '%Y-%m-%d')
      || ', ' || p_brand || '-' || strftime(l_shipdate, '%Y-%m') || ',' || n_name || '-'
      || strftime(l_shipdate, '%Y-%m') || ',' || c_mktsegment || '-' || strftime(l_shipdate, '%Y-%m')
      || repeat(',BULK-' || strftime(l_shipdate, '%Y-%m'), CAST(l_quantity % 7 AS INT)) AS promotion_ids
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON c_custkey = o_custkey
  JOIN nation ON n_nationkey = c_nationkey JOIN part ON p_partkey = l_partkey)"""

BOUGHT_SQL = """bought AS (
  SELECT state, order_date, size, CAST(round(amount * 100) AS HUGEINT) AS cents
  FROM sales WHERE lower(status) LIKE '%shipped%' AND qty <> 0)"""

COUNTS_SQL = "counts AS (SELECT state, count(*) AS total FROM bought GROUP BY state)"

BUCKETS_SQL = f"""buckets AS (
  SELECT bought.state, order_date + CAST(ahead AS INTEGER) AS window_date, size, count(*) AS n,
    sum(coalesce(cents, 0)) AS s, sum(coalesce(cents * cents, 0)) AS ss
  FROM bought JOIN counts ON bought.state = counts.state,
    unnest(range(1, CASE WHEN total > {TEST_THRESHOLD} THEN 6 ELSE 11 END)) AS t(ahead)
  GROUP BY ALL)"""

WINNERS_SQL = """winners AS (
  SELECT state, window_date, size AS most_bought_size, n AS frequency,
    round(CAST(n * ss - s * s AS DOUBLE) / CAST(n * n AS DOUBLE) / 10000.0, 4) AS population_variance
  FROM buckets QUALIFY row_number() OVER (PARTITION BY state, window_date ORDER BY n DESC, n * ss - s * s, size) = 1)"""

TOKENS_SQL = (
    "list_filter(list_transform(string_split(promotion_ids, ','), lambda x: trim(x)), lambda x: length(x) > 0)"
)

APPEARANCES_SQL = f"""appearances AS (
  SELECT order_id, order_date, unnest(list_distinct({TOKENS_SQL})) AS promotion_id
  FROM sales WHERE order_date IS NOT NULL)"""

VALID_SQL = """valid AS (
  SELECT promotion_id, min(order_date) AS first_appearance, max(order_date) AS last_appearance,
    CAST(date_diff('day', min(order_date), max(order_date)) AS INTEGER) AS active_days
  FROM appearances GROUP BY promotion_id HAVING date_diff('day', min(order_date), max(order_date)) >= 2)"""

ORDER_COUNTS_SQL = """order_counts AS (
  SELECT order_id, count(*) AS valid_promotion_count FROM appearances JOIN valid USING (promotion_id)
  GROUP BY order_id HAVING count(*) >= 3)"""

AVERAGES_SQL = """averages AS (
  SELECT state, count(*) AS n, avg(CAST(round(amount * 100) AS HUGEINT)) / 100 AS average FROM sales
  WHERE fulfilment = 'Merchant' AND courier_status = 'Shipped' AND state IS NOT NULL AND amount IS NOT NULL
  GROUP BY state)"""

SHARE_SQL = """share AS (
  SELECT city, count(*) AS total_records,
    count(*) FILTER (coalesce(valid_promotion_count, 0) >= 3 AND coalesce(amount, 0) < average) AS qualifying_records
  FROM sales LEFT JOIN order_counts USING (order_id) LEFT JOIN averages ON averages.state = sales.state
  WHERE service_level = 'Standard' AND lower(status) LIKE '%cancelled%' AND city IS NOT NULL
  GROUP BY city)"""

PREPARED_SQL = f"""prepared AS (
  SELECT style, sku, strftime(order_date, '%Y-%m') AS year_month, CAST(len({TOKENS_SQL}) AS INTEGER) AS promotion_count,
    amount FROM sales)"""


def thresholds_sql(name: str, function: str, keys: str = "style, year_month", source: str = "prepared") -> str:
    """One CTE with p80 and p90 per group by ``quantile_disc`` or ``quantile_cont``."""
    return f"""{name} AS (
  SELECT {keys}, count(*) AS order_count, CAST({function}(CAST(promotion_count AS DOUBLE), 0.8) AS DOUBLE) AS p80,
    CAST({function}(CAST(promotion_count AS DOUBLE), 0.9) AS DOUBLE) AS p90
  FROM {source} GROUP BY {keys})"""


def statistics_sql(name: str, thresholds: str, keys: str = "style, year_month", source: str = "prepared") -> str:
    """One CTE with the counts and spread of the rows at or above each threshold."""
    levels = ",\n    ".join(
        f"count(*) FILTER (promotion_count >= {p}) AS {p}_order_count, "
        f"count(amount) FILTER (promotion_count >= {p}) AS {p}_amount_count, "
        f"coalesce(stddev_pop(amount) FILTER (promotion_count >= {p}), 0) AS {p}_stddev"
        for p in ("p80", "p90")
    )
    return f"""{name} AS (
  SELECT {keys}, order_count, p80, p90,
    {levels}
  FROM {source} JOIN {thresholds} USING ({keys}) GROUP BY {keys}, order_count, p80, p90)"""


def comparison_sql(keys: str = "style, year_month") -> str:
    """One CTE comparing the CTEs ``approx`` and ``exact`` at both levels."""
    one = """SELECT {keys}, '{upper}' AS percentile, a.order_count AS order_count,
    a.{p} AS approx_threshold, e.{p} AS exact_threshold,
    a.{p}_order_count AS approx_selected, e.{p}_order_count AS exact_selected,
    a.{p}_stddev AS approx_stddev, e.{p}_stddev AS exact_stddev,
    abs(a.{p} - e.{p}) AS threshold_diff, abs(a.{p}_order_count - e.{p}_order_count) AS changed_order_count,
    abs(a.{p}_stddev - e.{p}_stddev) AS stddev_diff
  FROM approx a JOIN exact e USING ({keys})"""
    both = "\n  UNION ALL\n  ".join(one.format(keys=keys, p=p, upper=p.upper()) for p in ("p80", "p90"))
    return f"comparison AS (\n  {both})"


# The CSV layout writes years with two digits, and they are read back as 2000 to 2099.
RAW_SALES_SQL = (
    SALES_SQL.replace("sales AS", "typed AS", 1)
    + """,
sales AS (
  SELECT * REPLACE (CASE WHEN year(order_date) < 2000 THEN CAST(order_date + INTERVAL 100 YEAR AS DATE)
    ELSE order_date END AS order_date) FROM typed)"""
)


def with_(*parts: str, select: str, records: str = SALES_SQL) -> str:
    return "WITH " + ",\n".join((records, *parts)) + "\n" + select


def with_raw(*parts: str, select: str) -> str:
    return with_(*parts, select=select, records=RAW_SALES_SQL)


PERCENTAGE_CTES = (APPEARANCES_SQL, VALID_SQL, ORDER_COUNTS_SQL, AVERAGES_SQL, SHARE_SQL)
PERCENTAGE_SELECT = """SELECT city,
  CAST(qualifying_records AS DOUBLE) / CAST(total_records AS DOUBLE) * 100.0 AS percentage FROM share"""
PERCENTAGE_SQL = with_(*PERCENTAGE_CTES, select=PERCENTAGE_SELECT)
