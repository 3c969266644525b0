"""Whole jobs of a run date, from the raw zone to promotion, drift and the board.

Every job reads what earlier jobs stored and replaces its own run, so a repeated job changes nothing else. The
registry is a table of runs and a table of versions; the promoted model is the newest promoted version.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.errors import AnalysisException

from premia.operators.board import capped_history, median_trend, ranked_board
from premia.operators.registry import promotion_decisions, require_best_run
from premia.plans.features import feature_table
from premia.plans.landing import land_snapshot, land_tables
from premia.plans.monitoring import run_drift_check
from premia.plans.training import TrainingRun, save_model
from premia.sources.writers import Store, require_rows
from premia.spec import CANONICAL_SCHEMAS, HISTORY_CAP, PSI_THRESHOLD, FeatureSpec, SnapshotSpec

_RUN = "model STRING, run_id STRING, run_date STRING, val_rmse DOUBLE, n_train LONG, n_validation LONG"
_VERSION = "model STRING, run_id STRING, val_rmse DOUBLE, beat_metric DOUBLE, version LONG, promoted BOOLEAN"


def run_features(store: Store, spark: SparkSession, run_date: str, spec: FeatureSpec = FeatureSpec()) -> dict:
    """Compute a run's features from its raw zone, write them by brand, and report rows in and out."""
    raw = {name: store.read(spark, "raw", name, run_date) for name in CANONICAL_SCHEMAS}
    features = feature_table(raw["sales"], raw["shoes"], raw["drops"], raw["search_interest"], spec)
    store.write(features, "features", "features", run_date, ["brand"])
    written = store.read(spark, "features", "features", run_date)
    report = {"run_date": run_date, "rows_in": raw["sales"].count(), "rows_out": written.count()}
    store.write_report(spark, report, "features", "feature_report", run_date)
    return report


def run_snapshot(
    store: Store, prices: DataFrame, releases: DataFrame, reference: DataFrame, run_date: str,
    spec: SnapshotSpec = SnapshotSpec(),
) -> DataFrame:
    """Land a market snapshot: match, verify, write the raw zone. Returns the tables' profile.

    Nothing is written if products share an id or none lands.
    """
    landing = land_snapshot(prices, releases, reference, run_date, spec)
    landing.verify()
    profile = land_tables(store, landing.tables, run_date)
    store.write(landing.exclusions, "raw", "exclusions", run_date)
    return profile


def record_run(store: Store, spark: SparkSession, run: TrainingRun, run_date: str, run_id: str, model: str) -> None:
    """Save a trained model and its row in the table of runs."""
    save_model(store, spark, run, run_date, run_id)
    row = spark.createDataFrame([(model, run_id, run_date, run.val_rmse, run.n_train, run.n_validation)], _RUN)
    row.write.mode("overwrite").parquet(f"{store.path('models', 'runs')}/trained={run_date}/id={run_id}")


def recorded(store: Store, spark: SparkSession, table: str, schema: str) -> DataFrame:
    """A table of the models zone as it is so far; empty before anything is recorded."""
    try:
        return spark.read.parquet(store.path("models", table))
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def next_versions(candidates: DataFrame, versions: DataFrame, key: str, metric: str) -> DataFrame:
    """Decisions on candidates against the versions so far: the newest promoted one holds the alias."""
    incumbents = versions.where("promoted").groupBy(key).agg(F.max_by(metric, "version").alias(metric))
    last = versions.groupBy(key).agg(F.max("version").alias("last_version"))
    return promotion_decisions(candidates, incumbents, key, metric, last)


def run_registration(store: Store, spark: SparkSession, run_date: str, model: str) -> dict:
    """Register the best run of a run date as a new version; it takes the alias if it is strictly better.

    The registration of the same date is replaced, so a repeated job gives the same version. Writes the decision.
    """
    runs = recorded(store, spark, "runs", _RUN).where((F.col("model") == model) & (F.col("run_date") == run_date))
    best = require_best_run(runs, "val_rmse")
    earlier = recorded(store, spark, "versions", _VERSION + ", run_date STRING")
    earlier = earlier.where((F.col("model") == model) & (F.col("run_date").cast("string") != run_date))
    candidate = spark.createDataFrame([(model, best["run_id"], best["val_rmse"])], "model STRING, run_id STRING, val_rmse DOUBLE")
    decision = next_versions(candidate, earlier, "model", "val_rmse").first().asDict()
    row = spark.createDataFrame([tuple(decision[c.split()[0]] for c in _VERSION.split(", "))], _VERSION)
    store.write(row, "models", "versions", run_date, [])
    report = decision | {"run_date": run_date, "alias": "staging"}
    store.write_report(spark, report, "models", "promotion_report", run_date)
    return report


def promoted_version(store: Store, spark: SparkSession, model: str) -> dict | None:
    """The version that holds the alias, with the run date its run was trained on."""
    versions = recorded(store, spark, "versions", _VERSION + ", run_date STRING").where((F.col("model") == model) & F.col("promoted"))
    newest = versions.orderBy(F.desc("version")).select("version", "run_id").first()
    if newest is None:
        return None
    runs = recorded(store, spark, "runs", _RUN).where((F.col("model") == model) & (F.col("run_id") == newest["run_id"]))
    return newest.asDict() | {"run_date": runs.select("run_date").first()["run_date"]}


def run_monitoring(
    store: Store, spark: SparkSession, run_date: str, model: str, threshold: float = PSI_THRESHOLD,
    features: Sequence[str] | None = None, reasons: Mapping[str, str] | None = None,
) -> bool:
    """Drift of a run against the run that the promoted model was trained on; whether to retrain."""
    held = promoted_version(store, spark, model)
    return run_drift_check(store, spark, run_date, held and held["run_date"], threshold, features, reasons)


def run_board(store: Store, spark: SparkSession, run_date: str, scored: DataFrame, uncomputable: DataFrame | None = None,
              cap: int = HISTORY_CAP) -> DataFrame:
    """Write the ranked board of a scored snapshot with its report, and append its trend point to the stored history.

    All uncomputable codes are a table of the run; the report has their exact count.

    Returns the history, the newest ``cap`` points up to this run date.
    """
    board = ranked_board(scored)
    require_rows({"board": board})
    store.write(board, "predictions", "board", run_date)
    written = store.read(spark, "predictions", "board", run_date)
    codes = spark.createDataFrame([], "sku STRING") if uncomputable is None else uncomputable.select("sku")
    store.write(codes, "predictions", "uncomputable", run_date)
    codes = store.read(spark, "predictions", "uncomputable", run_date)
    n_codes = codes.count()
    report = {"run_date": run_date, "n_scored": written.count(), "n_uncomputable": n_codes}
    store.write_report(spark, report, "predictions", "board_report", run_date)
    return append_history(store, spark, run_date, median_trend(written), cap)


def append_history(store: Store, spark: SparkSession, run_date: str, points: DataFrame, cap: int = HISTORY_CAP) -> DataFrame:
    """The history with a run's points, stored as that run's history; ``points`` get the run date as ``ts``.

    It builds on the newest stored history before this run date, so a repeated run replaces its own point.
    """
    points = points.withColumn("ts", F.lit(run_date))
    try:
        stored = spark.read.parquet(store.path("predictions", "history"))
        before = stored.where(F.col("run_date").cast("string") < run_date)
        newest = before.agg(F.max(F.col("run_date").cast("string"))).first()[0]
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        newest = None
    history = points.limit(0) if newest is None else store.read(spark, "predictions", "history", newest)
    store.write(capped_history(history.select(*points.columns), points, ["ts"], cap), "predictions", "history", run_date)
    return store.read(spark, "predictions", "history", run_date)
