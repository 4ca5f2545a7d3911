"""The sales CSV layout."""

from pyspark.sql.types import StringType, StructField, StructType

# The 24 columns of a sales record, in file order. "Sales Channel " ends in a blank.
SALES_COLUMNS = (
    "index",
    "Order ID",
    "Date",
    "Status",
    "Fulfilment",
    "Sales Channel ",
    "ship-service-level",
    "Style",
    "SKU",
    "Category",
    "Size",
    "ASIN",
    "Courier Status",
    "Qty",
    "currency",
    "Amount",
    "ship-city",
    "ship-state",
    "ship-postal-code",
    "ship-country",
    "promotion-ids",
    "B2B",
    "fulfilled-by",
    "Unnamed: 22",
)

SALES_SCHEMA = StructType([StructField(name, StringType()) for name in SALES_COLUMNS])
