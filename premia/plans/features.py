"""The feature table: one row per sale."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from premia.functions.dates import days_between, whole_second
from premia.functions.prices import ordinal_encode, price_premium
from premia.operators.groups import attach, dimension_join, mean_of_totals
from premia.operators.trailing import (
    history_days,
    mean_signal_before_events,
    only_with_history,
    trailing_frame,
    trailing_totals,
)
from premia.session import materialize
from premia.spec import FEATURE_TABLE_COLUMNS, FeatureSpec


# Sales of a product up to which they all go to one task; a product with more goes through totals.
MOST_SALES = 2000

_PRODUCT = ["brand", "retail_price", "release_date", "release_type"]


def priced_sales(sales: DataFrame, shoes: DataFrame, spec: FeatureSpec = FeatureSpec()) -> DataFrame:
    """Sales with their product's columns and everything a single row determines."""
    rows = dimension_join(sales, shoes, "shoe_id", _PRODUCT)
    return rows.withColumns(
        {
            "price_premium": price_premium(F.col("sale_price"), F.col("retail_price")),
            "days_since_release": days_between(F.col("sale_date"), F.col("release_date")),
            "release_type_encoded": ordinal_encode(F.col("release_type"), spec.release_type_ranks),
        }
    )


def feature_table(
    sales: DataFrame,
    shoes: DataFrame,
    drops: DataFrame,
    search: DataFrame,
    spec: FeatureSpec = FeatureSpec(),
    most: int = MOST_SALES,
) -> DataFrame:
    """All features, in contract order.

    Products with at most ``most`` sales are shuffled once, by product, and get their statistics from windows there. The sales of the
    others are totalled first and joined to their statistics, so no large group is gathered in one task. The brand mean covers all
    rows, those after a later time split included.
    """
    products = materialize(shoes.select("shoe_id", *_PRODUCT), "products")
    rows = priced_sales(sales, products, spec).withColumn("at", whole_second(F.col("sale_date")))
    measured = materialize(
        rows.groupBy("shoe_id", "brand").agg(
            F.sum("price_premium").alias("_total"), F.count("price_premium").alias("_n"), F.count("*").alias("_rows")
        ),
        "product-totals",
    )
    # Stored, as their size decides at plan time that the sales need no shuffle to meet them.
    by_brand = materialize(measured.groupBy("brand").agg(mean_of_totals("_total", "_n").alias("brand_avg_premium")), "brand-means")
    frequent = materialize(
        measured.groupBy("shoe_id").agg(F.sum("_rows").alias("_rows")).where(F.col("_rows") > most).select("shoe_id"), "frequent"
    )
    demand = mean_signal_before_events(
        search, drops, "shoe_id", "signal_date", "drop_date", "search_index",
        spec.signal_days, "search_index_7d_pre_drop", spec.signal_grain,
    )
    # As a merge join, whatever the size: the sales are dealt out without their product's columns.
    dealt = priced_sales(sales, products.hint("merge"), spec).withColumn("at", whole_second(F.col("sale_date")))
    if frequent.isEmpty():
        features = _by_windows(dealt, demand, spec)
    else:
        features = _by_windows(dealt.join(frequent, "shoe_id", "left_anti"), demand, spec).unionByName(
            _by_totals(rows.join(frequent, "shoe_id", "left_semi"), demand, spec)
        )
    return attach(features, by_brand, ["brand"]).transform(project_contract)


def _by_windows(rows: DataFrame, demand: DataFrame, spec: FeatureSpec) -> DataFrame:
    """The rows of products with few sales and their statistics, by windows that share one partitioning."""
    shoe = Window.partitionBy("shoe_id")
    recent = trailing_frame(["shoe_id"], F.col("at"), spec.rolling_days, spec.sale_grain)
    # Rows of equal size, sizes that are NULL among them, as peers: a partition by size would be another shuffle.
    same_size = shoe.orderBy("size_us").rangeBetween(Window.currentRow, Window.currentRow)
    premium = F.avg("price_premium")
    history = history_days(F.col("sale_date"), F.min("at").over(shoe))
    features = rows.withColumns(
        {
            "rolling_7d_avg_premium": only_with_history(premium.over(recent), history, spec.rolling_days),
            "size_premium": premium.over(same_size) - premium.over(shoe),
        }
    )
    return attach(features, demand, ["shoe_id"])


def _by_totals(rows: DataFrame, demand: DataFrame, spec: FeatureSpec) -> DataFrame:
    """The rows of products with many sales and their statistics.

    The sales are totalled once per (product, brand, size, second). Every group feature is built from
    those totals and joined back, so no group is gathered in one task.
    """
    totals = rows.groupBy("shoe_id", "brand", "size_us", "at").agg(
        F.sum("price_premium").alias("_total"), F.count("price_premium").alias("_n")
    )
    totals = materialize(totals, "premium-totals")
    mean = mean_of_totals("_total", "_n")
    # A sale without a date is on no timeline.
    instants = totals.where("at IS NOT NULL").groupBy("shoe_id", "at").agg(
        F.sum("_total").alias("total"), F.sum("_n").alias("n")
    )
    rolling = trailing_totals(
        instants, ["shoe_id"], spec.rolling_days, grain=spec.sale_grain
    ).select(
        "shoe_id", "at", F.try_divide("total", "n").alias("_rolling")
    )
    by_shoe = totals.groupBy("shoe_id").agg(mean.alias("_base"), F.min("at").alias("_first_sale"))
    by_size = (
        attach(totals.groupBy("shoe_id", "size_us").agg(mean.alias("_mean")), by_shoe, ["shoe_id"])
        .join(demand, "shoe_id", "left")
        .withColumn("size_premium", F.col("_mean") - F.col("_base"))
        .drop("_mean", "_base")
    )

    # All statistics meet on the totals, which are as few as there are different keys; the sales, as wide as
    # they are, are joined once.
    keys = ["shoe_id", "brand", "size_us", "at"]
    stats = attach(totals.select(*keys), by_size, ["shoe_id", "size_us"], null_safe=True)
    stats = attach(stats, rolling, ["shoe_id", "at"])
    renamed = stats.withColumnsRenamed({k: f"_{k}" for k in keys})
    same = F.col("shoe_id") == F.col("_shoe_id")
    for key in keys[1:]:
        same = same & F.col(key).eqNullSafe(F.col(f"_{key}"))
    joined = rows.join(renamed, same)
    history = history_days(F.col("sale_date"), F.col("_first_sale"))
    rolled = joined.withColumn("rolling_7d_avg_premium", only_with_history(F.col("_rolling"), history, spec.rolling_days))
    return rolled.select(*rows.columns, "rolling_7d_avg_premium", "size_premium", "search_index_7d_pre_drop")


def project_contract(rows: DataFrame) -> DataFrame:
    """The columns of the feature table, in their fixed order, and no others."""
    return rows.select(*FEATURE_TABLE_COLUMNS)
