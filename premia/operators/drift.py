"""Distribution drift: the population stability index (PSI) of all features in one counting job."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from premia.functions.prices import nan_to_null
from premia.operators.quantiles import approximate_quantiles, evenly_spaced, exact_quantiles
from premia.spec import DEFAULT_EXCLUSION_REASON, PSI_BINS, PSI_FLOOR, PSI_THRESHOLD


def quantile_edges(
    reference: DataFrame, features: Sequence[str], bins: int = PSI_BINS, accuracy: int | None = None
) -> dict[str, list[float]]:
    """Distinct, ascending reference quantiles per feature. Fewer than ``bins`` + 1 if values repeat.

    With ``accuracy`` they come from a sketch of one pass, whose ranks are off by at most one in ``accuracy``; else they are exact.
    """
    if accuracy is None:
        quantiles = exact_quantiles(reference, features, evenly_spaced(bins))
    else:
        quantiles = approximate_quantiles(reference, features, evenly_spaced(bins), accuracy)
    return {feature: sorted(set(edges)) for feature, edges in quantiles.items()}


def edges_frame(spark, edges: Mapping[str, Sequence[float]]) -> DataFrame:
    """Edges as (feature, edge_no, edge) rows."""
    rows = [(f, i, float(e)) for f, es in edges.items() for i, e in enumerate(es)]
    return spark.createDataFrame(rows, "feature STRING, edge_no INT, edge DOUBLE")


def bin_of(value: Column, edges: Sequence[float]) -> Column:
    """Bin number of a value: bins are closed on the left, the outer two are open-ended."""
    inner = [F.when(value >= F.lit(float(e)), 1).otherwise(0) for e in edges[1:-1]]
    return reduce(add, inner, F.lit(0))


def bin_counts_of(rows: DataFrame, edges: Mapping[str, Sequence[float]]) -> DataFrame:
    """(feature, bin, n) of one sample; every row is read once for all features.

    A feature with fewer than two edges has no bins.
    """
    tagged = []
    for feature, feature_edges in edges.items():
        if len(feature_edges) >= 2:
            value = nan_to_null(F.col(feature).cast("double"))
            bin_no = F.when(value.isNotNull(), bin_of(value, feature_edges))
            tagged.append(F.struct(F.lit(feature).alias("feature"), bin_no.alias("bin")))
    if not tagged:
        return rows.sparkSession.createDataFrame([], "feature STRING, bin INT, n LONG")
    return (
        rows.select(F.inline(F.array(*tagged)))
        .where("bin IS NOT NULL")
        .groupBy("feature", "bin")
        .agg(F.count("*").alias("n"))
    )


def compare_counts(
    reference: DataFrame, current: DataFrame, edges: Mapping[str, Sequence[float]]
) -> DataFrame:
    """(feature, bin, n_reference, n_current) from two count frames, empty bins included as 0."""
    grid = [(f, b) for f, e in edges.items() for b in range(len(e) - 1)]
    return (
        reference.sparkSession.createDataFrame(grid, "feature STRING, bin INT")
        .join(reference.withColumnRenamed("n", "n_reference"), ["feature", "bin"], "left")
        .join(current.withColumnRenamed("n", "n_current"), ["feature", "bin"], "left")
        .na.fill(0, ["n_reference", "n_current"])
    )


def bin_counts(
    reference: DataFrame, current: DataFrame, edges: Mapping[str, Sequence[float]]
) -> DataFrame:
    """(feature, bin, n_reference, n_current) of two samples."""
    return compare_counts(bin_counts_of(reference, edges), bin_counts_of(current, edges), edges)


def psi_from_counts(
    reference: DataFrame,
    current: DataFrame,
    edges: Mapping[str, Sequence[float]],
    features: Sequence[str],
) -> DataFrame:
    """(feature, psi) from the bin counts of both sides.

    0.0 for a feature without bins and where a side has no values.
    """
    counts = compare_counts(reference, current, edges)
    totals = counts.groupBy("feature").agg(
        F.sum("n_reference").alias("_all_reference"), F.sum("n_current").alias("_all_current")
    )

    def share(n: str, total: str) -> Column:
        return F.greatest(F.col(n) / F.col(total), F.lit(PSI_FLOOR))

    shares = counts.join(totals.where("_all_reference > 0 AND _all_current > 0"), "feature").select(
        "feature",
        share("n_reference", "_all_reference").alias("_ref"),
        share("n_current", "_all_current").alias("_cur"),
    )
    term = (F.col("_cur") - F.col("_ref")) * F.log(F.col("_cur") / F.col("_ref"))
    measured = shares.groupBy("feature").agg(F.sum(term).alias("psi"))
    asked = reference.sparkSession.createDataFrame([(f,) for f in features], "feature STRING")
    return asked.join(measured, "feature", "left").na.fill(0.0, ["psi"])


def psi(
    reference: DataFrame,
    current: DataFrame,
    features: Sequence[str],
    bins: int = PSI_BINS,
) -> DataFrame:
    """(feature, psi) of two samples."""
    edges = quantile_edges(reference, features, bins)
    return psi_from_counts(
        bin_counts_of(reference, edges), bin_counts_of(current, edges), edges, features
    )


def drift_report(
    reference: DataFrame,
    current: DataFrame,
    features: Sequence[str],
    threshold: float = PSI_THRESHOLD,
    bins: int = PSI_BINS,
) -> DataFrame:
    """(feature, psi, drifted): a feature drifted if its unrounded PSI is above the threshold."""
    measured = psi(reference, current, features, bins)
    return measured.withColumn("drifted", F.col("psi") > F.lit(threshold))


def drift_summary(report: DataFrame, threshold: float = PSI_THRESHOLD) -> DataFrame:
    """One row: the threshold, how many features drifted, and whether any did."""
    return report.agg(
        F.lit(threshold).alias("psi_threshold"),
        F.count("*").alias("n_features"),
        F.count_if("drifted").alias("n_drifted_features"),
        F.coalesce(F.bool_or("drifted"), F.lit(False)).alias("drifted"),
    )


def drift_gate(report: DataFrame | None) -> bool:
    """Whether to retrain. Without a baseline there is nothing to compare with: retrain."""
    if report is None:
        return True
    return bool(report.agg(F.coalesce(F.bool_or("drifted"), F.lit(False))).first()[0])


def drift_coverage(
    spark,
    features: Sequence[str],
    measured: Sequence[str] | None,
    reasons: Mapping[str, str] | None = None,
) -> DataFrame:
    """(feature, measured, reason) for every feature. No measured list, or an empty one, means all."""
    chosen = set(measured or features)
    reasons = reasons or {}
    rows = [
        (f, f in chosen, None if f in chosen else reasons.get(f, DEFAULT_EXCLUSION_REASON))
        for f in features
    ]
    return spark.createDataFrame(rows, "feature STRING, measured BOOLEAN, reason STRING")
