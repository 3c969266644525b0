"""Queries over preparation, models, scoring, registry and board."""

from __future__ import annotations

from pyspark.sql import functions as F

from premia.catalog import feeds
from premia.catalog import tables as T
from premia.catalog.features import item_priced
from premia.catalog.landing import SNAPSHOT_DATE, _landing
from premia.catalog.registry import query, round_sql, rounded
from premia.operators.board import capped_history, median_trend, ranked_board
from premia.operators.models import (
    fit_linear,
    fit_linear_by,
    prediction_table,
    scoring_report,
    split_records,
)
from premia.operators.prep import (
    fit_preprocessing,
    preprocessing_stats,
    split_sizes,
    temporal_split,
)
from premia.operators.registry import best_runs, promotion_decisions
from premia.plans.scoring import score_snapshot, snapshot_features
from premia.plans.jobs import append_history, next_versions
from premia.sources.writers import Store
from premia.session import materialize, scratch_path
from premia.spec import PREDICTION_KEYS, TARGET, FeatureSpec
from premia.streaming.scoring import refused_records, scored_records, stream_outcomes

SPLIT_YEAR = 1999
_TWO_FEATURES = ["days_since_release", "retail_price"]
_RANKS = FeatureSpec().release_type_ranks

# Least squares on two features, in closed form.
_FIT_SQL = f""",
train AS (SELECT * FROM priced WHERE year(sale_date) < {SPLIT_YEAR}),
moments AS (
  SELECT avg(days_since_release) AS m1, stddev_pop(days_since_release) AS s1,
         avg(retail_price) AS m2, stddev_pop(retail_price) AS s2, avg(price_premium) AS my,
         var_pop(days_since_release) AS v1, var_pop(retail_price) AS v2,
         covar_pop(days_since_release, retail_price) AS v12,
         covar_pop(days_since_release, price_premium) AS c1, covar_pop(retail_price, price_premium) AS c2
  FROM train),
fit AS (
  SELECT m1, m2, s1, s2, my, s1 * (c1 * v2 - c2 * v12) / (v1 * v2 - v12 * v12) AS w1,
         s2 * (c2 * v1 - c1 * v12) / (v1 * v2 - v12 * v12) AS w2
  FROM moments),
scored AS (
  SELECT priced.*, my + w1 * (days_since_release - m1) / s1 + w2 * (retail_price - m2) / s2 AS predicted
  FROM priced, fit)"""


def _linear(priced):
    """The model of the rows before the split."""
    train, _ = temporal_split(priced, "sale_date", SPLIT_YEAR)
    return fit_linear(train, _TWO_FEATURES, TARGET)


@query("temporal_split", T.ITEM_PRICED_SQL + f"""
SELECT count(*) FILTER (year(sale_date) < {SPLIT_YEAR}) AS n_train,
       count(*) FILTER (year(sale_date) >= {SPLIT_YEAR}) AS n_validation FROM priced""")
def temporal_split_query(spark, folder):
    return split_sizes(item_priced(spark, folder), "sale_date", SPLIT_YEAR)


# Part sizes above 40 count as missing, and one feature is missing everywhere.
_GAPS_SQL = f"""WITH gaps AS (
  SELECT CASE WHEN p_size <= 40 THEN CAST(p_size AS DOUBLE) END AS size, p_retailprice AS retail,
         CAST(NULL AS DOUBLE) AS nothing, 7.0 AS constant
  FROM lineitem JOIN part ON l_partkey = p_partkey WHERE year(l_shipdate) < {SPLIT_YEAR}),
means AS (SELECT avg(size) AS m_size, avg(retail) AS m_retail FROM gaps)"""


def _gaps(spark, folder):
    parts = T.table(spark, folder, "part")
    items = T.table(spark, folder, "lineitem").select("l_partkey", "l_shipdate")
    train, _ = temporal_split(
        items.join(parts, F.col("l_partkey") == F.col("p_partkey")), "l_shipdate", SPLIT_YEAR
    )
    return train.selectExpr(
        "CASE WHEN p_size <= 40 THEN CAST(p_size AS DOUBLE) ELSE CAST('NaN' AS DOUBLE) END AS size",
        "p_retailprice AS retail", "CAST(NULL AS DOUBLE) AS nothing", "7.0D AS constant",
    )


_GAP_FEATURES = ["size", "retail", "nothing", "constant"]


@query("impute_fit", _GAPS_SQL + """
SELECT 'size' AS feature, round(m_size, 6) AS impute FROM means UNION ALL
SELECT 'retail', round(m_retail, 6) FROM means UNION ALL SELECT 'nothing', 0.0 UNION ALL SELECT 'constant', 7.0""")
def impute_fit_query(spark, folder):
    stats = preprocessing_stats(_gaps(spark, folder), _GAP_FEATURES)
    return rounded(stats.select("feature", "impute"), "impute")


@query("standardize_fit", _GAPS_SQL + """,
filled AS (SELECT coalesce(size, m_size) AS size, retail FROM gaps, means)
SELECT 'size' AS feature, round(avg(size), 6) AS mean, round(stddev_pop(size), 6) AS std FROM filled UNION ALL
SELECT 'retail', round(avg(retail), 6), round(stddev_pop(retail), 6) FROM filled UNION ALL
SELECT 'nothing', 0.0, 1.0 UNION ALL SELECT 'constant', 7.0, 1.0""")
def standardize_fit_query(spark, folder):
    stats = preprocessing_stats(_gaps(spark, folder), _GAP_FEATURES)
    return rounded(stats.select("feature", "mean", "std"), "mean", "std")


@query("impute_standardize_apply", T.ITEM_PRICED_SQL + f""",
gapped AS (SELECT *, CASE WHEN size_us < 6 THEN size_us END AS size_gap FROM priced),
train AS (SELECT * FROM gapped WHERE year(sale_date) < {SPLIT_YEAR}),
means AS (SELECT avg(days_since_release) AS md, stddev_pop(days_since_release) AS sd,
                 avg(size_gap) AS mg FROM train),
spread AS (SELECT stddev_pop(coalesce(size_gap, mg)) AS sg FROM train, means)
SELECT sale_id, shoe_id, sale_price, round((days_since_release - md) / sd, 4) AS days_since_release,
       round((coalesce(size_gap, mg) - mg) / sg, 4) AS size_gap
FROM gapped, means, spread""")
def impute_standardize_apply_query(spark, folder):
    rows = item_priced(spark, folder).withColumn("size_gap", F.expr("CASE WHEN size_us < 6 THEN size_us END"))
    train, _ = temporal_split(rows, "sale_date", SPLIT_YEAR)
    features = ["days_since_release", "size_gap"]
    scaled = fit_preprocessing(train, features).apply(rows)
    return rounded(scaled.select("sale_id", "shoe_id", "sale_price", *features), *features, places=4)


@query("linear_fit", T.ITEM_PRICED_SQL + _FIT_SQL + """
SELECT 'days_since_release' AS term, round(w1, 6) AS weight FROM fit UNION ALL
SELECT 'retail_price', round(w2, 6) FROM fit UNION ALL SELECT 'intercept', round(my, 6) FROM fit""")
def linear_fit_query(spark, folder):
    model = _linear(item_priced(spark, folder))
    terms = [*zip(_TWO_FEATURES, model.coefficients), ("intercept", model.intercept)]
    return rounded(spark.createDataFrame(terms, "term STRING, weight DOUBLE"), "weight")


@query("linear_fit_by", T.ITEM_PRICED_SQL + """,
gapped AS (SELECT shoe_id % 50 AS line, size_us, price_premium, CASE WHEN shoe_id % 3 = 0 AND size_us > 5 THEN NULL ELSE size_us END AS size_gap FROM priced),
filled AS (SELECT *, coalesce(size_gap, avg(size_gap) OVER (PARTITION BY line)) AS size FROM gapped),
fits AS (SELECT line, count(*) AS n, regr_slope(price_premium, size) AS slope, regr_intercept(price_premium, size) AS start FROM filled GROUP BY line)
SELECT line, n, 'size_gap' AS term, round(slope, 6) AS weight FROM fits UNION ALL SELECT line, n, 'intercept', round(start, 6) FROM fits""")
def linear_fit_by_query(spark, folder):
    """A model per product line, premium by size, some sizes missing."""
    priced = item_priced(spark, folder).selectExpr(
        "shoe_id % 50 AS line", "price_premium", "CASE WHEN shoe_id % 3 = 0 AND size_us > 5 THEN NULL ELSE size_us END AS size_gap"
    )
    return rounded(fit_linear_by(priced, ["size_gap"], TARGET, ["line"]), "weight")


@query("score_batch", T.ITEM_PRICED_SQL + _FIT_SQL + """
SELECT sale_id, shoe_id, brand, sale_date, round(predicted, 4) AS predicted_premium,
       price_premium AS actual_premium FROM scored""")
def score_batch_query(spark, folder):
    priced = item_priced(spark, folder)
    predictions = prediction_table(_linear(priced).score(priced), PREDICTION_KEYS, TARGET)
    return rounded(predictions, "predicted_premium", places=4)


@query("rmse", T.ITEM_PRICED_SQL + _FIT_SQL + """
SELECT count(*) AS n_scored, round(sqrt(avg(pow(predicted - price_premium, 2))), 5) AS rmse_vs_actual FROM scored""")
def rmse_query(spark, folder):
    priced = item_priced(spark, folder)
    predictions = prediction_table(_linear(priced).score(priced), PREDICTION_KEYS, TARGET)
    return scoring_report(predictions)


# Feature records made of line items: some without a size, some without retail.
_RECORDS = {
    "order_key": "l_orderkey", "line": "l_linenumber", "part_key": "l_partkey",
    "price": "l_extendedprice",
    "days_since_release": "l_quantity", "size_us": "CAST(l_linenumber - 1 AS DOUBLE)",
    "retail_price": "CASE WHEN l_returnflag = 'R' AND l_linestatus = 'F' THEN NULL "
                    "WHEN l_suppkey % 7 = 3 THEN CAST('NaN' AS DOUBLE) ELSE l_extendedprice END",
    "size_premium": "l_discount", "release_type_encoded": "CAST(l_linenumber AS DOUBLE)",
    "brand_avg_premium": "l_tax",
    "rolling_7d_avg_premium": "CASE WHEN l_linestatus = 'O' THEN l_discount END",
    "search_index_7d_pre_drop": "CAST(NULL AS DOUBLE)",
}
_RECORDS_SQL = "SELECT " + ", ".join(f"{e} AS {c}" for c, e in _RECORDS.items()) + " FROM lineitem"
_VALID_SQL = "size_us > 0 AND retail_price > 0 AND retail_price IS NOT NULL AND NOT isnan(retail_price)"
_RECORD_MODEL_SQL = f"""WITH records AS ({_RECORDS_SQL}),
fit AS (SELECT regr_slope(l_quantity, l_extendedprice) AS slope, avg(l_quantity) AS my,
               avg(l_extendedprice) AS mx FROM lineitem),
rolling AS (SELECT avg(rolling_7d_avg_premium) AS mr FROM records),
scored AS (
  SELECT order_key, line, part_key, price, my + slope * (retail_price - mx) AS predicted,
         coalesce(rolling_7d_avg_premium, mr) AS rolling_used
  FROM records, fit, rolling WHERE {_VALID_SQL})"""


def _records(spark, folder):
    return T.table(spark, folder, "lineitem").selectExpr(*(f"{e} AS {c}" for c, e in _RECORDS.items()))


def _record_model(spark, folder):
    """Quantity from price: a model that records can be scored with."""
    train = T.table(spark, folder, "lineitem").selectExpr(
        "l_extendedprice AS retail_price", "l_quantity AS target"
    )
    return fit_linear(train, ["retail_price"], "target")


@query("score_records", _RECORD_MODEL_SQL + """
SELECT order_key, line, part_key, price, round(predicted, 4) AS predicted_premium FROM scored""")
def score_records_query(spark, folder):
    valid, _ = split_records(_records(spark, folder))
    scored = _record_model(spark, folder).score(valid)
    columns = ["order_key", "line", "part_key", "price", "predicted_premium"]
    return rounded(scored.select(*columns), "predicted_premium", places=4)


@query("refused_records", f"""WITH records AS ({_RECORDS_SQL})
SELECT order_key, line, part_key, price FROM records WHERE NOT coalesce({_VALID_SQL}, false)""")
def refused_records_query(spark, folder):
    _, refused = split_records(_records(spark, folder))
    return refused.select("order_key", "line", "part_key", "price")


def _record_stream(spark, folder):
    schema = spark.read.parquet(f"{folder}/lineitem.parquet").schema
    items = spark.readStream.schema(schema).option("pathGlobFilter", "lineitem.parquet").parquet(folder)
    return items.selectExpr(*(f"{e} AS {c}" for c, e in _RECORDS.items()))


@query("stream_score", _RECORD_MODEL_SQL + """
SELECT order_key, line, part_key, price, round(predicted, 4) AS predicted_premium FROM scored""")
def stream_score_query(spark, folder):
    columns = ["order_key", "line", "part_key", "price", "predicted_premium"]
    return rounded(scored_records(spark, *_streamed(spark, folder)).select(*columns), "predicted_premium", places=4)


def _streamed(spark, folder):
    """All records through one stream: where its outcomes are, and the schema of a record."""
    output, checkpoint = scratch_path(spark, "outcomes"), scratch_path(spark, "outcomes-checkpoint")
    stream = _record_stream(spark, folder)
    stream_outcomes(stream, _record_model(spark, folder), output, checkpoint).awaitTermination()
    return output, stream.schema


@query("stream_refused", f"""WITH records AS ({_RECORDS_SQL})
SELECT order_key, line, part_key, price FROM records WHERE NOT coalesce({_VALID_SQL}, false)""")
def stream_refused_query(spark, folder):
    return refused_records(spark, *_streamed(spark, folder)).select("order_key", "line", "part_key", "price")


# --- Registry -----------------------------------------------------------------------------------

# Orders are training runs, the price is the metric, the priority the model, the year the run date.
_RUNS_SQL = """
runs AS (
  SELECT o_orderkey AS run_id, o_orderpriority AS model, date_trunc('year', o_orderdate)::DATE AS run_date,
         CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_totalprice END AS val_rmse
  FROM orders)"""


def _runs(spark, folder):
    return T.table(spark, folder, "orders").selectExpr(
        "o_orderkey AS run_id", "o_orderpriority AS model",
        "to_date(date_trunc('year', o_orderdate)) AS run_date",
        "CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_totalprice END AS val_rmse",
    )


@query("best_run", f"WITH {_RUNS_SQL}" + """
SELECT model, CAST(run_date AS TIMESTAMP) AS run_date, run_id, val_rmse FROM runs
QUALIFY row_number() OVER (PARTITION BY model, run_date ORDER BY val_rmse NULLS LAST, run_id) = 1""")
def best_run_query(spark, folder):
    best = best_runs(_runs(spark, folder), ["model", "run_date"], "val_rmse")
    return best.withColumn("run_date", F.col("run_date").cast("timestamp_ntz"))


@query("promotion_gate", f"WITH {_RUNS_SQL}" + """,
dated AS (SELECT *, max(run_date) OVER () AS last_date FROM runs),
candidates AS (
  SELECT model, run_id, val_rmse FROM dated WHERE run_date = last_date AND val_rmse IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY model ORDER BY val_rmse, run_id) = 1),
incumbents AS (
  SELECT model, min(val_rmse) AS beat_metric, count(DISTINCT run_date) AS last_version
  FROM dated WHERE run_date < last_date GROUP BY model)
SELECT model, run_id, val_rmse, beat_metric, last_version + 1 AS version,
       beat_metric IS NULL OR val_rmse < beat_metric AS promoted
FROM candidates LEFT JOIN incumbents USING (model)""")
def promotion_gate_query(spark, folder):
    """The best run of the last year against the best run of all years before."""
    runs = _runs(spark, folder)
    last = runs.agg(F.max("run_date").alias("last_date"))
    dated = runs.join(F.broadcast(last), F.col("run_date") <= F.col("last_date"))
    earlier = dated.where("run_date < last_date")
    candidates = best_runs(
        dated.where("run_date = last_date AND val_rmse IS NOT NULL"), ["model"], "val_rmse"
    )
    incumbents = best_runs(earlier, ["model"], "val_rmse")
    versions = earlier.groupBy("model").agg(F.count_distinct("run_date").alias("last_version"))
    return promotion_decisions(candidates, incumbents, "model", "val_rmse", versions)


@query("registry_versions", f"WITH {_RUNS_SQL}" + """,
best AS (
  SELECT * FROM runs WHERE val_rmse IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY model, run_date ORDER BY val_rmse, run_id) = 1),
held AS (
  SELECT *, min(val_rmse) OVER (PARTITION BY model ORDER BY run_date ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS beat_metric,
         row_number() OVER (PARTITION BY model ORDER BY run_date) AS version FROM best)
SELECT model, CAST(run_date AS VARCHAR) AS run_date, run_id, val_rmse, beat_metric, version,
       beat_metric IS NULL OR val_rmse < beat_metric AS promoted FROM held""")
def registry_versions_query(spark, folder):
    """Promotion over all run dates, each against the state that the one before left."""
    runs = materialize(_runs(spark, folder).where("val_rmse IS NOT NULL"), "runs")
    dates = [r[0] for r in runs.select("run_date").distinct().orderBy("run_date").collect()]
    state = spark.createDataFrame(
        [], "model STRING, run_date STRING, run_id LONG, val_rmse DOUBLE, beat_metric DOUBLE, version LONG, promoted BOOLEAN"
    )
    for date in dates:
        candidates = best_runs(runs.where(F.col("run_date") == F.lit(date)), ["model"], "val_rmse")
        decided = next_versions(candidates, state, "model", "val_rmse").withColumn("run_date", F.lit(str(date)))
        state = materialize(state.unionByName(decided.select(*state.columns)), "versions")
    return state


@query("history_append", """
WITH points AS (
  SELECT strftime(o_orderdate, '%Y-%m') AS ts, count(*) AS n, round(max(o_totalprice), 4) AS model_premium,
         round(min(o_totalprice), 4) AS market_premium
  FROM orders GROUP BY ALL)
SELECT ts, n, model_premium, market_premium FROM points ORDER BY ts DESC LIMIT 5""")
def history_append_query(spark, folder):
    """A point per month of all orders appended to the stored history, of which the last five are kept."""
    store = Store(scratch_path(spark, "history"))
    orders = T.table(spark, folder, "orders")
    points = materialize(
        orders.groupBy(F.date_format("o_orderdate", "yyyy-MM").alias("month")).agg(
            F.count("*").alias("n"), F.round(F.max("o_totalprice"), 4).alias("model_premium"),
            F.round(F.min("o_totalprice"), 4).alias("market_premium"),
        ),
        "points",
    )
    history = None
    for month in [r[0] for r in points.select("month").orderBy("month").collect()]:
        history = append_history(store, spark, month, points.where(F.col("month") == month).drop("month"), cap=5)
    return history.select("ts", "n", "model_premium", "market_premium")


# --- Snapshot scoring and board -----------------------------------------------------------------

_SNAPSHOT_SQL = f"""WITH {feeds.LANDED_SQL},
snapshot AS (
  SELECT l.row_id AS sale_id, l.shoe_id, s.brand, s.model, s.colorway, s.retail_price, l.sale_price,
         date_diff('day', s.release_date::DATE, DATE '{SNAPSHOT_DATE}') AS days_since_release,
         CASE s.release_type WHEN 'limited' THEN 2 WHEN 'collab' THEN 1 WHEN 'general' THEN 0 END
           AS release_type_encoded,
         (l.sale_price - s.retail_price) / s.retail_price AS premium
  FROM landed l JOIN landed s USING (shoe_id)),
averaged AS (SELECT *, avg(premium) OVER (PARTITION BY brand) AS brand_avg_premium FROM snapshot),
fit AS (SELECT regr_slope(l_quantity, l_extendedprice) AS slope, avg(l_quantity) AS my,
               avg(l_extendedprice) AS mx FROM lineitem),
predicted AS (SELECT *, my + slope * (retail_price - mx) AS predicted FROM averaged, fit)"""


def _snapshot_tables(spark, folder):
    tables = _landing(spark, folder).tables
    return {name: materialize(tables[name], f"snapshot-{name}") for name in ("sales", "shoes")}


@query("snapshot_features", _SNAPSHOT_SQL + """
SELECT sale_id, shoe_id, model, CAST(days_since_release AS BIGINT) AS days_since_release,
       CAST(release_type_encoded AS BIGINT) AS release_type_encoded, 0.0 AS size_premium,
       CAST(NULL AS DOUBLE) AS rolling_7d_avg_premium, round(brand_avg_premium, 6) AS brand_avg_premium
FROM averaged""")
def snapshot_features_query(spark, folder):
    rows = snapshot_features(_snapshot_tables(spark, folder), _RANKS)
    return rounded(
        rows.select(
            "sale_id", "shoe_id", "model", "days_since_release",
            F.col("release_type_encoded").cast("long").alias("release_type_encoded"),
            "size_premium", "rolling_7d_avg_premium", "brand_avg_premium",
        ),
        "brand_avg_premium",
    )


@query("score_snapshot", _SNAPSHOT_SQL + """
SELECT shoe_id, brand, model, colorway, retail_price, sale_price, round(predicted, 4) AS predicted_premium,
       round(retail_price * (1 + predicted), 2) AS implied_resale
FROM predicted""")
def score_snapshot_query(spark, folder):
    scored = score_snapshot(_snapshot_tables(spark, folder), _record_model(spark, folder), _RANKS)
    return rounded(
        rounded(scored, "predicted_premium", places=4), "implied_resale", places=2
    )


# Line items as scored products: the discount is the predicted premium.
_BOARD_SQL = f"""WITH board AS (
  SELECT l_orderkey * 1000000 + l_partkey * 10 + l_linenumber AS shoe_id, p_brand || ' ' || p_name AS name,
         l_returnflag AS note, {round_sql('p_retailprice', 2)} AS retail, {round_sql('l_extendedprice', 2)} AS market,
         {round_sql('l_discount', 4)} AS premium,
         {round_sql('p_retailprice * (1 + l_discount)', 2)} AS implied_resale
  FROM lineitem JOIN part ON l_partkey = p_partkey)"""


def _board(spark, folder):
    items = T.table(spark, folder, "lineitem").join(
        T.table(spark, folder, "part"), F.col("l_partkey") == F.col("p_partkey")
    )
    return ranked_board(
        items.selectExpr(
            "l_orderkey * 1000000 + l_partkey * 10 + l_linenumber AS shoe_id", "p_brand AS brand",
            "p_name AS model", "concat(' ', l_returnflag, ' ') AS colorway",
            "p_retailprice AS retail_price", "l_extendedprice AS sale_price",
            "l_discount AS predicted_premium", "p_retailprice * (1 + l_discount) AS implied_resale",
        )
    )


@query("ranked_board", _BOARD_SQL + " SELECT * FROM board ORDER BY premium DESC, shoe_id")
def ranked_board_query(spark, folder):
    return _board(spark, folder)


@query("median_trend", _BOARD_SQL + """
SELECT count(*) AS n, round(quantile_cont(premium, 0.5), 4) AS model_premium,
       round(quantile_cont((market - retail) / retail, 0.5), 4) AS market_premium FROM board""")
def median_trend_query(spark, folder):
    return median_trend(_board(spark, folder))


@query("capped_history", """
WITH points AS (
  SELECT o_orderkey AS ts, o_totalprice AS model_premium FROM orders UNION ALL
  SELECT event_id, value FROM events WHERE event_type = 'purchase')
SELECT ts, model_premium FROM points ORDER BY ts DESC, model_premium DESC LIMIT 240""")
def capped_history_query(spark, folder):
    history = T.table(spark, folder, "orders").selectExpr("o_orderkey AS ts", "o_totalprice AS model_premium")
    points = T.table(spark, folder, "events").where("event_type = 'purchase'").selectExpr(
        "event_id AS ts", "value AS model_premium"
    )
    return capped_history(history, points, ["ts", "model_premium"])
