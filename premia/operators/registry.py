"""Model registry decisions over tables of runs and versions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from premia.functions.prices import nan_to_null


def best_runs(runs: DataFrame, keys: Sequence[str], metric: str, run_id: str = "run_id") -> DataFrame:
    """Per key: the run with the lowest metric (the lowest run id among equals).

    Runs without a metric lose to every other run; a key that has only such runs keeps a NULL metric.
    """
    rank = F.struct(F.col(metric).isNull(), F.col(metric), F.col(run_id))
    best = F.min(F.struct(rank.alias("rank"), F.col(run_id).alias("run"), F.col(metric).alias("metric")))
    return (
        runs.groupBy(*keys)
        .agg(best.alias("best"))
        .select(*keys, F.col("best.run").alias(run_id), F.col("best.metric").alias(metric))
    )


def require_best_run(runs: DataFrame, metric: str, run_id: str = "run_id"):
    """The best run of a run date. No runs, or none with the metric, is an error."""
    row = best_runs(runs, [], metric, run_id).first()
    if row is None or row[run_id] is None:
        raise LookupError("no training runs to choose from")
    if row[metric] is None:
        raise LookupError(f"run {row[run_id]} has no {metric}")
    return row


def promotion_decisions(
    candidates: DataFrame,
    incumbents: DataFrame,
    key: str,
    metric: str,
    last_versions: DataFrame,
) -> DataFrame:
    """One decision per candidate: a new version, promoted only if strictly better.

    ``incumbents`` holds the promoted run's metric per model, ``last_versions`` the highest version so
    far. ``beat_metric`` is the incumbent's metric, NULL if there is none. A candidate without a metric (NULL or
    NaN) fails the job; an incumbent without one is beaten.
    """
    missing = F.raise_error(F.concat(F.lit(f"a candidate has no {metric}: "), F.coalesce(F.col(key).cast("string"), F.lit("NULL"))))
    measured = F.coalesce(nan_to_null(F.col(metric).cast("double")), missing.cast("double"))
    candidates = candidates.withColumn(metric, measured)
    held = incumbents.select(key, nan_to_null(F.col(metric).cast("double")).alias("beat_metric"))
    versions = last_versions.select(key, "last_version")
    beaten = F.col("beat_metric").isNull() | (F.col(metric) < F.col("beat_metric"))
    return (
        candidates.join(held, key, "left")
        .join(versions, key, "left")
        .withColumn("version", F.coalesce(F.col("last_version"), F.lit(0)) + F.lit(1))
        .withColumn("promoted", beaten)
        .drop("last_version")
    )
