"""Readers. Every column comes in as text; the record views in ``orderlens.plans`` parse what they need.

A quoted line break ends a record: ``multiLine`` stays off so that big files split across tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from orderlens.functions.text import strip
from orderlens.operators.checks import quality_profile
from orderlens.sources.schema import SALES_COLUMNS, SALES_SCHEMA

CORRUPT = "_corrupt"


def read_sales(spark: SparkSession, path: str) -> DataFrame:
    """CSV with a header, by the 24-column layout. Short rows are padded with nulls, extra fields are dropped."""
    return spark.read.schema(SALES_SCHEMA).option("header", True).option("mode", "PERMISSIVE").csv(path)


def read_sales_strict(spark: SparkSession, path: str) -> DataFrame:
    """CSV with columns named by its header; a row of another width ends the job.

    Spark skips the fields a query does not use and with them the width check, so that is switched off here.
    """
    reader = spark.read.option("header", True).option("inferSchema", False).option("mode", "FAILFAST")
    return reader.option("columnPruning", False).csv(path)


def read_sales_lines(spark: SparkSession, path: str, unescape_quotes: bool = True) -> DataFrame:
    """Every line of headerless or many-headed CSV, with ``_corrupt`` holding the lines that are not 24 fields wide.

    Commas and backslashes inside quotes have no meaning. A doubled quote inside quotes becomes one quote. Without
    ``unescape_quotes`` it stays as it is: fields are then cut at the commas that an even number of quotes follows,
    stripped, and freed of one quote at either end. All fields are parsed whatever the query uses: with column pruning
    on, Spark does not look at the width.
    """
    if not unescape_quotes:
        return _cut_lines(spark.read.text(path))
    schema = StructType([*SALES_SCHEMA.fields, StructField(CORRUPT, StringType())])
    reader = spark.read.schema(schema).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
    return reader.option("columnPruning", False).option("escape", '"').csv(path)


def _cut_lines(lines: DataFrame) -> DataFrame:
    """Lines (``value``) as fields. Those without a quote are split at their commas. The others are split at their
    quotes: counted from the end, every second piece, the last one first, has an even number of quotes behind it, and
    its commas part fields. A line break marks these commas, since no line holds one.
    """
    quoted = F.contains("value", F.lit('"'))

    def marked(piece: Column, i: Column) -> Column:
        return F.when(i % 2 == 0, F.replace(piece, F.lit(","), F.lit("\n"))).otherwise(piece)

    backwards = F.transform(F.reverse(F.split("value", '"')), marked)
    cut = F.split(F.array_join(F.reverse(backwards), '"'), "\n")
    # Exploded, so that filters on fields are not turned into filters that cut each line again.
    fields = F.explode(F.array(F.when(quoted, cut).otherwise(F.split("value", ","))))
    rows = lines.select("value", fields.alias("fields"))

    def field(i: int) -> Column:
        text = strip(F.get("fields", F.lit(i)))
        return F.when(F.contains(text, F.lit('"')), F.regexp_replace(text, '^"|"$', "")).otherwise(text)

    wide = F.size("fields") == len(SALES_COLUMNS)
    columns = [field(i).alias(name) for i, name in enumerate(SALES_COLUMNS)]
    return rows.select(*columns, F.when(~wide, F.col("value")).alias(CORRUPT))


def is_header() -> Column:
    return F.coalesce(F.lower(strip(F.col("index"))) == "index", F.lit(False))


def read_sales_rows(spark: SparkSession, path: str, unescape_quotes: bool = True) -> DataFrame:
    """``read_sales_lines`` without the lines of a wrong width and without headers, wherever they stand."""
    lines = read_sales_lines(spark, path, unescape_quotes)
    return lines.where(F.col(CORRUPT).isNull() & ~is_header()).select(*[f"`{name}`" for name in SALES_COLUMNS])


def line_quality(lines: DataFrame) -> DataFrame:
    """Lines of a wrong width, and headers among the rest, as rows (rule, rows)."""
    wide = F.col(CORRUPT).isNull()
    return quality_profile(lines, {"BAD_CSV_ROWS": ~wide, "HEADER_ROWS": wide & is_header()})


def read_results(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)
