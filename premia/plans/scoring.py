"""Scoring batches and snapshots through the one transform the model was trained with."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from premia.functions.dates import elapsed_days
from premia.functions.prices import implied_resale, ordinal_encode, price_premium
from premia.functions.skus import normalize_sku, sku_candidates, stable_id
from premia.operators.groups import attach_group_mean
from premia.operators.matching import first_candidate_match, requested_only, without_match
from premia.operators.models import prediction_table, scoring_report, split_records
from premia.operators.ordering import keep_last
from premia.sources.writers import Store
from premia.spec import PREDICTION_KEYS, SNAPSHOT_IDENTITY, TARGET


def score_batch(features: DataFrame, model) -> DataFrame:
    """Keys, prediction, and the true premium where the batch has it."""
    return prediction_table(model.score(features), PREDICTION_KEYS, TARGET)


def score_records(records: DataFrame, model) -> tuple[DataFrame, DataFrame]:
    """Scored records, and the refused ones. A batch without any record is an error."""
    if records.isEmpty():
        raise ValueError("empty batch")
    valid, refused = split_records(records)
    return model.score(valid), refused


def snapshot_features(tables: Mapping[str, DataFrame], ranks: Mapping[str, int]) -> DataFrame:
    """The features a one-off snapshot supports; the others are constant or missing.

    A release type without a rank fails the job, since the model could not be given the row.
    """
    rows = tables["sales"].join(tables["shoes"], "shoe_id")
    rows = rows.withColumns(
        {
            "_premium": price_premium(F.col("sale_price"), F.col("retail_price")),
            "days_since_release": elapsed_days(F.col("sale_date"), F.col("release_date")),
            "release_type_encoded": ordinal_encode(F.col("release_type"), ranks, unmapped="raise"),
            "size_premium": F.lit(0.0),
            "rolling_7d_avg_premium": F.lit(None).cast("double"),
            "search_index_7d_pre_drop": F.lit(None).cast("double"),
        }
    )
    return attach_group_mean(rows, ["brand"], "_premium", "brand_avg_premium").drop("_premium")


def score_snapshot(tables: Mapping[str, DataFrame], model, ranks: Mapping[str, int]) -> DataFrame:
    """Identity columns, prediction and the resale price it implies."""
    scored = model.score(snapshot_features(tables, ranks))
    return scored.select(
        *SNAPSHOT_IDENTITY,
        "predicted_premium",
        implied_resale(F.col("retail_price"), F.col("predicted_premium")).alias("implied_resale"),
    )


def requested_ids(requests: DataFrame, request_key: str, sku: str, reference: DataFrame) -> DataFrame:
    """(shoe_id) of the requested codes the reference resolves."""
    entries = reference.withColumn("_code", normalize_sku(F.col("sku"))).where("_code <> ''")
    entries = keep_last(entries, ["_code"], "ordinal").select("_code", "sku")
    asked = requests.select(request_key, sku_candidates(F.col(sku)).alias("_candidates"))
    resolved = first_candidate_match(asked, request_key, "_candidates", entries, "_code", "ref")
    return (
        resolved.where("ref IS NOT NULL")
        .select(stable_id(normalize_sku(F.col("ref.sku"))).alias("shoe_id"))
        .distinct()
    )


def score_current(
    tables: Mapping[str, DataFrame],
    model,
    ranks: Mapping[str, int],
    reference: DataFrame,
    requests: DataFrame | None = None,
) -> tuple[DataFrame, DataFrame | None]:
    """Scored snapshot, narrowed to requests (``request_id``, ``sku``), and the uncomputable requests."""
    scored = score_snapshot(tables, model, ranks)
    if requests is None:
        return scored, None
    wanted = requested_ids(requests, "request_id", "sku", reference)
    missing = without_match(requests, "request_id", "sku", reference, "sku")
    return requested_only(scored, "shoe_id", wanted), missing


def run_scoring(store: Store, spark, run_date: str, model) -> str:
    """Score one run's validated features; write predictions and a report."""
    predictions = score_batch(store.read(spark, "validated", "features", run_date), model)
    path = store.write(predictions, "predictions", "predictions", run_date)
    written = store.read(spark, "predictions", "predictions", run_date)
    store.write_report(spark, scoring_report(written), "predictions", "scoring_report", run_date)
    return path
