"""The drift check of a run against the run its model was trained on."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import functions as F

from premia.functions.prices import round_exact
from premia.operators.drift import drift_coverage, drift_gate, drift_report
from premia.sources.writers import Store
from premia.spec import MODEL_FEATURES, PSI_THRESHOLD


def run_drift_check(
    store: Store,
    spark,
    run_date: str,
    reference_run_date: str | None,
    threshold: float = PSI_THRESHOLD,
    features: Sequence[str] | None = None,
    reasons: Mapping[str, str] | None = None,
) -> bool:
    """Write the drift report of a run and return whether to retrain.

    ``features`` narrows the check; the other model features are listed with the reason they are not
    measured. Without a reference run the answer is yes.
    """
    if reference_run_date is None:
        report = {
            "run_date": run_date,
            "reference_run_date": None,
            "drifted": True,
            "reason": "no model to compare against",
        }
        store.write_report(spark, report, "drift", "drift_report", run_date)
        return drift_gate(None)
    reference = store.read(spark, "validated", "features", reference_run_date)
    current = store.read(spark, "validated", "features", run_date)
    measured = list(features) if features else list(MODEL_FEATURES)
    report = drift_report(reference, current, measured, threshold)
    coverage = drift_coverage(spark, MODEL_FEATURES, measured, reasons)
    full = coverage.join(report, "feature", "left").select(
        "feature", "measured", "reason", round_exact(F.col("psi"), 5).alias("psi"), "drifted",
        F.lit(reference_run_date).alias("reference_run_date"),
        F.lit(threshold).alias("psi_threshold"),
        F.lit(reference.count()).alias("n_reference"),
        F.lit(current.count()).alias("n_current"),
    )
    store.write(full, "drift", "drift_features", run_date)
    return drift_gate(store.read(spark, "drift", "drift_features", run_date))
