"""Canonical views of the given tables, once as DataFrames and once as SQL.

Two readings of the same tables:

* line items are sales of parts (large, and with prices and dates that break the contract);
* purchase events are sales of the part with the buyer's number (clean).

Parts are the products, the orders of a part are its drops.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from premia.sources.readers import without_nan


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A given table."""
    return without_nan(spark.read.parquet(f"{folder}/{name}.parquet"))


def release_type(kind: str = "p_type"):
    """PROMO parts are limited, ECONOMY and SMALL ones collaborations, the rest general."""
    return (
        F.when(F.col(kind) == "PROMO", "limited")
        .when(F.col(kind).isin("ECONOMY", "SMALL"), "collab")
        .otherwise("general")
    )


def drops(spark: SparkSession, folder: str) -> DataFrame:
    items = table(spark, folder, "lineitem").select("l_orderkey", "l_partkey")
    orders = table(spark, folder, "orders").select("o_orderkey", "o_orderdate")
    return items.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("o_orderkey").alias("drop_id"),
        F.col("l_partkey").alias("shoe_id"),
        F.col("o_orderdate").alias("drop_date"),
        F.lit("order").alias("drop_type"),
        F.lit(None).cast("timestamp_ntz").alias("announced_at"),
    )


def shoes(spark: SparkSession, folder: str, dropped: DataFrame | None = None) -> DataFrame:
    """The products; ``dropped`` are their drops where the caller has them already."""
    first = (drops(spark, folder) if dropped is None else dropped).groupBy("shoe_id").agg(F.min("drop_date").alias("release_date"))
    parts = table(spark, folder, "part").select(
        F.col("p_partkey").alias("shoe_id"),
        F.col("p_brand").alias("brand"),
        F.col("p_name").alias("model"),
        F.substring_index("p_name", " ", 1).alias("colorway"),
        F.col("p_retailprice").alias("retail_price"),
        release_type().alias("release_type"),
        F.col("p_type").alias("silhouette"),
    )
    return parts.join(first, "shoe_id")


def item_sales(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "lineitem").select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("sale_id"),
        F.col("l_partkey").alias("shoe_id"),
        F.col("l_returnflag").alias("platform"),
        F.try_divide("l_extendedprice", "l_quantity").alias("sale_price"),
        F.col("l_shipdate").alias("sale_date"),
        F.col("l_linenumber").cast("double").alias("size_us"),
        F.col("l_linestatus").alias("condition"),
        F.col("l_suppkey").cast("string").alias("source_item_id"),
    )


def item_signals(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "lineitem").select(
        F.col("l_partkey").alias("shoe_id"),
        F.col("l_shipdate").alias("signal_date"),
        F.col("l_returnflag").alias("platform"),
        F.col("l_quantity").cast("long").alias("search_index"),
    )


def event_sales(spark: SparkSession, folder: str) -> DataFrame:
    events = table(spark, folder, "events").where("event_type = 'purchase'")
    return events.select(
        F.col("event_id").alias("sale_id"),
        F.col("user_id").alias("shoe_id"),
        F.lit("web").alias("platform"),
        F.col("value").alias("sale_price"),
        F.col("ts").alias("sale_date"),
        (F.lit(6.0) + F.col("event_id") % 8).alias("size_us"),
        F.lit("new").alias("condition"),
        F.col("event_id").cast("string").alias("source_item_id"),
    )


def event_drops(spark: SparkSession, folder: str) -> DataFrame:
    events = table(spark, folder, "events").where("event_type = 'signup'")
    return events.select(
        F.col("event_id").alias("drop_id"),
        F.col("user_id").alias("shoe_id"),
        F.col("ts").alias("drop_date"),
        F.lit("signup").alias("drop_type"),
        F.lit(None).cast("timestamp_ntz").alias("announced_at"),
    )


def event_signals(spark: SparkSession, folder: str) -> DataFrame:
    events = table(spark, folder, "events").where("event_type IN ('view', 'click')")
    return events.select(
        F.col("user_id").alias("shoe_id"),
        F.col("ts").alias("signal_date"),
        F.col("event_type").alias("platform"),
        F.col("value").cast("int").cast("long").alias("search_index"),
    )


# --- The same views for the oracle --------------------------------------------------------------

DROPS_SQL = """
drops AS (
  SELECT o_orderkey AS drop_id, l_partkey AS shoe_id, o_orderdate AS drop_date,
         'order' AS drop_type, CAST(NULL AS TIMESTAMP) AS announced_at
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""

SHOES_SQL = (
    DROPS_SQL
    + """,
shoes AS (
  SELECT p_partkey AS shoe_id, p_brand AS brand, p_name AS model,
         split_part(p_name, ' ', 1) AS colorway, p_retailprice AS retail_price, release_date,
         CASE WHEN p_type = 'PROMO' THEN 'limited'
              WHEN p_type IN ('ECONOMY', 'SMALL') THEN 'collab' ELSE 'general' END AS release_type,
         p_type AS silhouette
  FROM part JOIN (SELECT shoe_id, min(drop_date) AS release_date FROM drops GROUP BY shoe_id) d
    ON d.shoe_id = p_partkey)"""
)

ITEM_SALES_SQL = """
sales AS (
  SELECT l_orderkey * 10 + l_linenumber AS sale_id, l_partkey AS shoe_id,
         l_returnflag AS platform, l_extendedprice / NULLIF(l_quantity, 0) AS sale_price,
         l_shipdate AS sale_date, CAST(l_linenumber AS DOUBLE) AS size_us,
         l_linestatus AS condition, CAST(l_suppkey AS VARCHAR) AS source_item_id
  FROM lineitem)"""

ITEM_SIGNALS_SQL = """
signals AS (
  SELECT l_partkey AS shoe_id, l_shipdate AS signal_date, l_returnflag AS platform,
         CAST(trunc(l_quantity) AS BIGINT) AS search_index
  FROM lineitem)"""

EVENT_SALES_SQL = """
sales AS (
  SELECT event_id AS sale_id, user_id AS shoe_id, 'web' AS platform, value AS sale_price,
         ts AS sale_date, CAST(6 + event_id % 8 AS DOUBLE) AS size_us, 'new' AS condition,
         CAST(event_id AS VARCHAR) AS source_item_id
  FROM events WHERE event_type = 'purchase')"""

EVENT_DROPS_SQL = """
event_drops AS (
  SELECT event_id AS drop_id, user_id AS shoe_id, ts AS drop_date
  FROM events WHERE event_type = 'signup')"""

EVENT_SIGNALS_SQL = """
signals AS (
  SELECT user_id AS shoe_id, ts AS signal_date, event_type AS platform,
         CAST(trunc(value) AS BIGINT) AS search_index
  FROM events WHERE event_type IN ('view', 'click'))"""

PRICED_SQL = """
priced AS (
  SELECT s.*, brand, retail_price, release_date, release_type,
         (sale_price - retail_price) / NULLIF(retail_price, 0) AS price_premium,
         date_diff('day', release_date::DATE, sale_date::DATE) AS days_since_release,
         CASE release_type WHEN 'limited' THEN 2 WHEN 'collab' THEN 1 WHEN 'general' THEN 0 END
           AS release_type_encoded,
         epoch_us(sale_date) // 1000000 AS sale_second
  FROM sales s JOIN shoes USING (shoe_id))"""

FEATURES_SQL = """
windowed AS (
  SELECT *,
    avg(price_premium) OVER (PARTITION BY shoe_id ORDER BY sale_second
      RANGE BETWEEN 604800 PRECEDING AND CURRENT ROW) AS rolling,
    date_diff('day', (min(sale_date) OVER (PARTITION BY shoe_id))::DATE, sale_date::DATE) AS history,
    avg(price_premium) OVER (PARTITION BY shoe_id, size_us)
      - avg(price_premium) OVER (PARTITION BY shoe_id) AS size_premium,
    CASE WHEN brand IS NOT NULL THEN avg(price_premium) OVER (PARTITION BY brand) END
      AS brand_avg_premium
  FROM priced),
demand AS (
  SELECT g.shoe_id, avg(search_index) AS search_index_7d_pre_drop
  FROM signals g JOIN {drops} d ON g.shoe_id = d.shoe_id
    AND signal_date <= drop_date
    AND signal_date >= date_trunc('day', drop_date) - INTERVAL 7 DAYS
  GROUP BY g.shoe_id),
features AS (
  SELECT sale_id, shoe_id, brand, size_us, sale_date, release_date, retail_price, sale_price,
         release_type, price_premium, days_since_release, size_premium, release_type_encoded,
         CASE WHEN history >= 7 THEN rolling END AS rolling_7d_avg_premium,
         search_index_7d_pre_drop, brand_avg_premium
  FROM windowed LEFT JOIN demand USING (shoe_id))"""

ITEM_PRICED_SQL = f"WITH {SHOES_SQL}, {ITEM_SALES_SQL}, {PRICED_SQL}"
EVENT_PRICED_SQL = f"WITH {SHOES_SQL}, {EVENT_SALES_SQL}, {PRICED_SQL}"
ITEM_FEATURES_SQL = f"{ITEM_PRICED_SQL}, {ITEM_SIGNALS_SQL}, {FEATURES_SQL.format(drops='drops')}"
EVENT_FEATURES_SQL = (
    f"{EVENT_PRICED_SQL}, {EVENT_DROPS_SQL}, {EVENT_SIGNALS_SQL}, "
    f"{FEATURES_SQL.format(drops='event_drops')}"
)
