"""Queries over sales: joins, group features, trailing features, the feature table."""

from __future__ import annotations

from pyspark.sql import functions as F

from premia.catalog import tables as T
from premia.catalog.registry import query, rounded
from premia.functions.dates import elapsed_days
from premia.functions.prices import implied_resale, ordinal_encode, price_premium
from premia.operators.groups import (
    attach_contrast,
    attach_group_mean,
    attach_group_min,
    dimension_join,
    group_mean,
)
from premia.operators.trailing import (
    attach_trailing_mean,
    history_days,
    matches_before_event,
    mean_signal_before_events,
    only_with_history,
    trailing_mean,
)
from premia.plans.features import feature_table, priced_sales, project_contract
from premia.session import materialize
from premia.spec import FEATURE_TABLE_COLUMNS, FeatureSpec

# Ship and order dates are midnights.
ITEM_SPEC = FeatureSpec(sale_grain="day", signal_grain="day")
FEATURE_AVERAGES = [
    "size_premium", "rolling_7d_avg_premium", "search_index_7d_pre_drop", "brand_avg_premium",
]


def item_priced(spark, folder):
    return priced_sales(T.item_sales(spark, folder), T.shoes(spark, folder))


def event_priced(spark, folder):
    return priced_sales(T.event_sales(spark, folder), T.shoes(spark, folder))


def item_features(spark, folder):
    # Stored once: release dates and the demand before drops both read them, and line items meet orders in a shuffle.
    drops = materialize(T.drops(spark, folder).select("shoe_id", "drop_date"), "drops")
    return feature_table(
        T.item_sales(spark, folder),
        T.shoes(spark, folder, drops),
        drops,
        T.item_signals(spark, folder),
        ITEM_SPEC,
    )


def event_features(spark, folder):
    return feature_table(
        T.event_sales(spark, folder),
        T.shoes(spark, folder),
        T.event_drops(spark, folder),
        T.event_signals(spark, folder),
    )


def _comparable(features):
    whole = {c: F.col(c).cast("long") for c in ("days_since_release", "release_type_encoded")}
    return rounded(features.withColumns(whole), *FEATURE_AVERAGES)


_FEATURES_SELECT = """
SELECT sale_id, shoe_id, brand, size_us, sale_date, release_date, retail_price,
       sale_price, release_type, price_premium,
       CAST(days_since_release AS BIGINT) AS days_since_release,
       round(size_premium, 6) AS size_premium,
       CAST(release_type_encoded AS BIGINT) AS release_type_encoded,
       round(rolling_7d_avg_premium, 6) AS rolling_7d_avg_premium,
       round(search_index_7d_pre_drop, 6) AS search_index_7d_pre_drop,
       round(brand_avg_premium, 6) AS brand_avg_premium
FROM features"""


@query("feature_table", T.ITEM_FEATURES_SQL + _FEATURES_SELECT)
def feature_table_query(spark, folder):
    return _comparable(item_features(spark, folder))


@query("feature_table_events", T.EVENT_FEATURES_SQL + _FEATURES_SELECT)
def feature_table_events_query(spark, folder):
    return _comparable(event_features(spark, folder))


@query("project_contract", T.EVENT_FEATURES_SQL + _FEATURES_SELECT)
def project_contract_query(spark, folder):
    """Features in another order, among other columns, brought into the contract's form."""
    features = event_features(spark, folder)
    shuffled = features.select(F.lit(1).alias("extra"), *reversed(features.columns))
    projected = project_contract(shuffled)
    if projected.columns != FEATURE_TABLE_COLUMNS:
        raise AssertionError(f"the contract's columns are {FEATURE_TABLE_COLUMNS}")
    return _comparable(projected)


@query("price_premium", T.ITEM_PRICED_SQL + """
SELECT sale_id, shoe_id, sale_price, retail_price,
       price_premium FROM priced""")
def price_premium_query(spark, folder):
    rows = dimension_join(
        T.item_sales(spark, folder), T.shoes(spark, folder), "shoe_id", ["retail_price"]
    )
    premium = price_premium(F.col("sale_price"), F.col("retail_price")).alias("price_premium")
    return rows.select("sale_id", "shoe_id", "sale_price", "retail_price", premium)


@query("implied_resale", """
SELECT l_orderkey, l_linenumber, l_partkey, round(l_extendedprice * (1 + l_discount), 4) AS implied_resale
FROM lineitem""")
def implied_resale_query(spark, folder):
    items = T.table(spark, folder, "lineitem")
    resale = implied_resale(F.col("l_extendedprice"), F.col("l_discount"))
    return items.select(
        "l_orderkey", "l_linenumber", "l_partkey", F.round(resale, 4).alias("implied_resale")
    )


@query("ordinal_encode", """
SELECT l_orderkey, l_partkey, l_linenumber, p_type,
       CAST(CASE p_type WHEN 'PROMO' THEN 3 WHEN 'SMALL' THEN 2 WHEN 'ECONOMY' THEN 1 END AS DOUBLE)
         AS type_rank
FROM lineitem JOIN part ON l_partkey = p_partkey""")
def ordinal_encode_query(spark, folder):
    parts = T.table(spark, folder, "part").select("p_partkey", "p_type")
    items = T.table(spark, folder, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber")
    rank = ordinal_encode(F.col("p_type"), {"PROMO": 3, "SMALL": 2, "ECONOMY": 1}).cast("double")
    return items.join(parts, F.col("l_partkey") == F.col("p_partkey")).select(
        "l_orderkey", "l_partkey", "l_linenumber", "p_type", rank.alias("type_rank")
    )


@query("dim_join", T.ITEM_PRICED_SQL + """
SELECT sale_id, shoe_id, brand, retail_price, release_date, release_type FROM priced""")
def dim_join_query(spark, folder):
    columns = ["brand", "retail_price", "release_date", "release_type"]
    return dimension_join(
        T.item_sales(spark, folder).select("sale_id", "shoe_id"),
        T.shoes(spark, folder), "shoe_id", columns,
    ).select("sale_id", "shoe_id", *columns)


@query("brand_avg_premium", T.ITEM_PRICED_SQL + """
SELECT brand, round(avg(price_premium), 6) AS brand_avg_premium FROM priced GROUP BY brand""")
def brand_avg_premium_query(spark, folder):
    means = group_mean(item_priced(spark, folder), ["brand"], "price_premium", "brand_avg_premium")
    return rounded(means, "brand_avg_premium")


# In the next two, one brand is blanked so that rows without a brand occur.
_UNBRANDED = "CASE WHEN brand <> 'Brand#7' THEN brand END"


@query("agg_join_back", T.ITEM_PRICED_SQL + f""",
masked AS (SELECT sale_id, shoe_id, {_UNBRANDED} AS brand, price_premium FROM priced)
SELECT sale_id, shoe_id, m.brand, round(brand_avg_premium, 6) AS brand_avg_premium
FROM masked m LEFT JOIN
  (SELECT brand, avg(price_premium) AS brand_avg_premium FROM masked GROUP BY brand) b
  ON m.brand = b.brand""")
def agg_join_back_query(spark, folder):
    rows = item_priced(spark, folder).withColumn("brand", F.expr(_UNBRANDED))
    joined = attach_group_mean(rows, ["brand"], "price_premium", "brand_avg_premium")
    return rounded(
        joined.select("sale_id", "shoe_id", "brand", "brand_avg_premium"), "brand_avg_premium"
    )


@query("group_mean_transform", T.EVENT_PRICED_SQL + f""",
masked AS (SELECT sale_id, shoe_id, {_UNBRANDED} AS brand, price_premium FROM priced)
SELECT sale_id, brand,
       round(CASE WHEN brand IS NOT NULL THEN avg(price_premium) OVER (PARTITION BY brand) END, 6)
         AS brand_avg_premium
FROM masked""")
def group_mean_transform_query(spark, folder):
    rows = event_priced(spark, folder).withColumn("brand", F.expr(_UNBRANDED))
    joined = attach_group_mean(rows, ["brand"], "price_premium", "brand_avg_premium")
    return rounded(joined.select("sale_id", "brand", "brand_avg_premium"), "brand_avg_premium")


@query("size_premium", T.ITEM_PRICED_SQL + """
SELECT sale_id, shoe_id, size_us,
       round(avg(price_premium) OVER (PARTITION BY shoe_id, size_us)
             - avg(price_premium) OVER (PARTITION BY shoe_id), 6) AS size_premium
FROM priced""")
def size_premium_query(spark, folder):
    rows = attach_contrast(
        item_priced(spark, folder), ["shoe_id"], ["size_us"], "price_premium", "size_premium"
    )
    return rounded(rows.select("sale_id", "shoe_id", "size_us", "size_premium"), "size_premium")


_ROLLING = """avg(price_premium) OVER (PARTITION BY shoe_id ORDER BY sale_second
         RANGE BETWEEN 604800 PRECEDING AND CURRENT ROW)"""
_HISTORY = """date_diff('day', (min(sale_date) OVER (PARTITION BY shoe_id))::DATE, sale_date::DATE)"""


@query("rolling_avg_time", T.ITEM_PRICED_SQL + f"""
SELECT sale_id, shoe_id, sale_date, round({_ROLLING}, 6) AS rolling_avg FROM priced""")
def rolling_avg_time_query(spark, folder):
    rows = attach_trailing_mean(
        item_priced(spark, folder), ["shoe_id"], "sale_date", "price_premium", 7, "rolling_avg", "day"
    )
    return rounded(rows.select("sale_id", "shoe_id", "sale_date", "rolling_avg"), "rolling_avg")


@query("rolling_avg_seconds", """
SELECT user_id, to_timestamp(second)::TIMESTAMP AS at, round(rolling_avg, 6) AS rolling_avg
FROM (
  SELECT DISTINCT user_id, epoch_us(ts) // 1000000 AS second,
    avg(value) OVER (PARTITION BY user_id ORDER BY epoch_us(ts) // 1000000
      RANGE BETWEEN 604800 PRECEDING AND CURRENT ROW) AS rolling_avg
  FROM events)""")
def rolling_avg_seconds_query(spark, folder):
    events = T.table(spark, folder, "events")
    return rounded(trailing_mean(events, ["user_id"], "ts", "value", 7, "rolling_avg"), "rolling_avg")


@query("days_of_history", T.ITEM_PRICED_SQL + f"""
SELECT sale_id, shoe_id, sale_date, CAST({_HISTORY} AS BIGINT) AS days_of_history FROM priced""")
def days_of_history_query(spark, folder):
    rows = attach_group_min(item_priced(spark, folder), ["shoe_id"], "sale_date", "first_sale")
    history = history_days(F.col("sale_date"), F.col("first_sale")).cast("long")
    return rows.select("sale_id", "shoe_id", "sale_date", history.alias("days_of_history"))


@query("rolling_avg_gated", T.EVENT_PRICED_SQL + f"""
SELECT sale_id, shoe_id, sale_date,
       round(CASE WHEN {_HISTORY} >= 7 THEN {_ROLLING} END, 6) AS rolling_7d_avg_premium
FROM priced""")
def rolling_avg_gated_query(spark, folder):
    rows = event_priced(spark, folder)
    rows = attach_trailing_mean(rows, ["shoe_id"], "sale_date", "price_premium", 7, "rolling_avg")
    rows = attach_group_min(rows, ["shoe_id"], "sale_date", "first_sale")
    history = history_days(F.col("sale_date"), F.col("first_sale"))
    gated = only_with_history(F.col("rolling_avg"), history, 7).alias("rolling_7d_avg_premium")
    return rounded(rows.select("sale_id", "shoe_id", "sale_date", gated), "rolling_7d_avg_premium")


@query("first_event_transform", """
SELECT event_id, user_id, ts, min(ts) OVER (PARTITION BY user_id) AS first_event FROM events""")
def first_event_transform_query(spark, folder):
    events = T.table(spark, folder, "events").select("event_id", "user_id", "ts")
    return attach_group_min(events, ["user_id"], "ts", "first_event")


@query("pre_event_range_join", f"WITH {T.DROPS_SQL}, {T.ITEM_SIGNALS_SQL}" + """
SELECT g.shoe_id, drop_id, drop_date, signal_date, search_index
FROM signals g JOIN drops d ON g.shoe_id = d.shoe_id AND signal_date <= drop_date
 AND signal_date >= date_trunc('day', drop_date) - INTERVAL 7 DAYS""")
def pre_event_range_join_query(spark, folder):
    matches = matches_before_event(
        T.item_signals(spark, folder), T.drops(spark, folder), "shoe_id", "signal_date", "drop_date", 7
    )
    return matches.select("shoe_id", "drop_id", "drop_date", "signal_date", "search_index")


_DEMAND_SQL = """
SELECT g.shoe_id, round(avg(search_index), 6) AS search_index_7d_pre_drop
FROM signals g JOIN {drops} d ON g.shoe_id = d.shoe_id AND signal_date <= drop_date
 AND signal_date >= date_trunc('day', drop_date) - INTERVAL 7 DAYS
GROUP BY g.shoe_id"""


def _item_demand(spark, folder):
    return mean_signal_before_events(
        T.item_signals(spark, folder), T.drops(spark, folder), "shoe_id", "signal_date", "drop_date",
        "search_index", 7, "search_index_7d_pre_drop", "day",
    )


@query(
    "pre_drop_avg", f"WITH {T.DROPS_SQL}, {T.ITEM_SIGNALS_SQL}" + _DEMAND_SQL.format(drops="drops")
)
def pre_drop_avg_query(spark, folder):
    return rounded(_item_demand(spark, folder), "search_index_7d_pre_drop")


@query(
    "pre_drop_avg_events",
    f"WITH {T.EVENT_DROPS_SQL}, {T.EVENT_SIGNALS_SQL}" + _DEMAND_SQL.format(drops="event_drops"),
)
def pre_drop_avg_events_query(spark, folder):
    demand = mean_signal_before_events(
        T.event_signals(spark, folder), T.event_drops(spark, folder), "shoe_id", "signal_date",
        "drop_date", "search_index", 7, "search_index_7d_pre_drop",
    )
    return rounded(demand, "search_index_7d_pre_drop")


@query("left_attach", f"WITH {T.SHOES_SQL}, {T.ITEM_SIGNALS_SQL}, demand AS (" + _DEMAND_SQL.format(
    drops="drops") + """)
SELECT shoe_id, brand, search_index_7d_pre_drop FROM shoes LEFT JOIN demand USING (shoe_id)""")
def left_attach_query(spark, folder):
    shoes = T.shoes(spark, folder).select("shoe_id", "brand")
    return rounded(
        shoes.join(_item_demand(spark, folder), "shoe_id", "left"), "search_index_7d_pre_drop"
    )


@query("days_between", T.EVENT_PRICED_SQL + """
SELECT sale_id, CAST(days_since_release AS BIGINT) AS days_since_release FROM priced""")
def days_between_query(spark, folder):
    priced = event_priced(spark, folder)
    return priced.select("sale_id", F.col("days_since_release").cast("long").alias("days_since_release"))


@query("elapsed_days", """
SELECT event_id, CAST(floor((epoch_us(ts) - min(epoch_us(ts)) OVER (PARTITION BY user_id))
                            / 86400000000.0) AS BIGINT) AS elapsed_days
FROM events""")
def elapsed_days_query(spark, folder):
    events = T.table(spark, folder, "events").select("event_id", "user_id", "ts")
    rows = attach_group_min(events, ["user_id"], "ts", "first_event")
    return rows.select("event_id", elapsed_days(F.col("ts"), F.col("first_event")).alias("elapsed_days"))


@query("year_of", "SELECT l_orderkey, l_linenumber, CAST(year(l_shipdate) AS BIGINT) AS sale_year FROM lineitem")
def year_of_query(spark, folder):
    items = T.table(spark, folder, "lineitem")
    return items.select("l_orderkey", "l_linenumber", F.year("l_shipdate").cast("long").alias("sale_year"))
