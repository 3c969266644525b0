"""Market feeds: current prices, release records and the curated retail reference."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from premia.operators.ordering import numbered
from premia.sources.readers import scan_json

# --- Fixed values: the fields kept from each feed, with their types ------------------------------
PRICE_RECORD = (
    "id STRING, sku STRING, brand STRING, model STRING, title STRING, primary_title STRING, "
    "secondary_title STRING, product_type STRING, category STRING, avg_price STRING, "
    "min_price STRING, max_price STRING, weekly_orders LONG, rank LONG"
)
RELEASE_RECORD = (
    "id STRING, sku STRING, brand STRING, model STRING, name STRING, nickname STRING, "
    "colorway STRING, season STRING, release_date STRING, release_date_year STRING, "
    "product_type STRING"
)
REFERENCE_RECORD = (
    "sku STRING, retail_price DOUBLE, release_type STRING, brand STRING, model STRING, "
    "colorway STRING, silhouette STRING, release_date STRING"
)


def _feed(spark: SparkSession, path: str, record: str) -> DataFrame:
    """Records with one integer ``ordinal``: files by name, records by position.

    The files are listed without reading them, and numbered by a distributed sort.
    """
    listed = spark.read.format("binaryFile").load(path).select(F.col("_metadata.file_path").alias("_file"))
    ranked = numbered(listed, [F.col("_file")], "_rank")
    ordinal = (F.col("_rank") - 1) * F.lit(2**32) + F.col("position")
    rows = scan_json(spark, path, record)
    return rows.join(ranked, "_file").withColumn("ordinal", ordinal).drop("_file", "_rank", "position")


def read_prices(spark: SparkSession, path: str) -> DataFrame:
    return _feed(spark, path, PRICE_RECORD)


def read_releases(spark: SparkSession, path: str) -> DataFrame:
    return _feed(spark, path, RELEASE_RECORD)


def read_reference(spark: SparkSession, path: str) -> DataFrame:
    """The reference; an entry without a positive retail price fails the job."""
    price = F.col("retail_price")
    good = F.coalesce((price > 0) & ~F.isnan(price), F.lit(False))
    wrong = F.raise_error(F.concat(F.lit("no retail price in the reference entry "), F.coalesce("sku", F.lit("NULL")))).cast("double")
    return _feed(spark, path, REFERENCE_RECORD).withColumn("retail_price", F.when(good, price).otherwise(wrong))
