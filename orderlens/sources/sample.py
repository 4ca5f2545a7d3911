"""Sales records derived from the star-schema test tables, typed or in the CSV layout."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlens.functions.parsing import DATE_PATTERN, month_of
from orderlens.sources.schema import SALES_COLUMNS

TABLES = ("lineitem", "orders", "customer", "nation", "part")


def load(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")


def sales(spark: SparkSession, folder: str) -> DataFrame:
    """One sales record per line item: 14 columns, typed.

    ``promotion_ids`` holds a blank, a repeat with a leading space and up to six equal bulk ids per record. Orders meet
    their customers first, so that the many line items are shuffled once for their parts and once for their orders.
    """
    lineitem, orders, customer, nation, part = (load(spark, folder, t) for t in TABLES)
    day = F.col("l_shipdate").cast("date")
    month, iso_day = month_of(day), day.cast("string")
    flag, size = F.col("l_returnflag"), F.col("p_size")
    brand_month = F.concat("p_brand", F.lit("-"), month)
    promotions = F.concat(
        brand_month,
        F.lit(",,"),
        F.concat("p_type", F.lit("-"), iso_day),
        F.lit(", "),
        brand_month,
        F.lit(","),
        F.concat("n_name", F.lit("-"), month),
        F.lit(","),
        F.concat("c_mktsegment", F.lit("-"), month),
        F.repeat(F.concat(F.lit(",BULK-"), month), (F.col("l_quantity") % 7).cast("int")),
    )
    size_name = F.when(size == 50, "XXL").when(size == 49, "3XL").when(size > 40, "Free").when(size > 30, "XL")
    size_name = size_name.when(size > 20, "L").when(size > 10, "M").otherwise("S")
    status = F.when(flag == "A", "Shipped").when(flag == "N", "Shipped - Delivered to Buyer").otherwise("Cancelled")
    courier = F.when(flag == "R", "Cancelled").when(F.col("o_orderstatus") == "P", "Unshipped").otherwise("Shipped")
    buyers = customer.join(nation, F.col("n_nationkey") == F.col("c_nationkey"))
    bought = orders.join(buyers, F.col("c_custkey") == F.col("o_custkey"))
    return (
        lineitem.join(part, F.col("p_partkey") == F.col("l_partkey"))
        .join(bought.hint("shuffle_hash"), F.col("l_orderkey") == F.col("o_orderkey"))
        .select(
            F.col("l_orderkey").cast("string").alias("order_id"),
            day.alias("order_date"),
            status.alias("status"),
            F.when(F.col("l_linestatus") == "O", "Merchant").otherwise("Platform").alias("fulfilment"),
            F.when(F.col("o_orderpriority").isin("4-NOT SPECIFIED", "5-LOW"), "Standard")
            .otherwise("Expedited")
            .alias("service_level"),
            courier.alias("courier_status"),
            F.concat("c_mktsegment", F.lit("-"), F.col("n_regionkey").cast("string")).alias("city"),
            F.col("n_name").alias("state"),
            F.col("p_brand").alias("style"),
            F.concat(F.lit("P"), F.col("p_partkey").cast("string")).alias("sku"),
            size_name.alias("size"),
            F.col("l_quantity").alias("qty"),
            F.when(F.col("l_tax") != 0.08, F.col("l_extendedprice")).alias("amount"),
            promotions.alias("promotion_ids"),
        )
    )


# Where each typed column goes in the CSV layout.
PLACES = {
    "Order ID": "order_id",
    "Status": "status",
    "Fulfilment": "fulfilment",
    "ship-service-level": "service_level",
    "Style": "style",
    "SKU": "sku",
    "Size": "size",
    "Courier Status": "courier_status",
    "Qty": "qty",
    "Amount": "amount",
    "ship-city": "city",
    "ship-state": "state",
    "promotion-ids": "promotion_ids",
}


def as_raw(records: DataFrame) -> DataFrame:
    """``sales`` records as the 24 text columns of the CSV layout; columns without a source are null."""
    columns = {name: F.col(source).cast("string") for name, source in PLACES.items()}
    columns["index"] = F.concat(F.lit("r"), F.col("order_id"))
    columns["Date"] = F.date_format("order_date", DATE_PATTERN)
    return records.select(
        *[columns.get(name, F.lit(None).cast("string")).alias(name) for name in SALES_COLUMNS]
    )
