"""The contract gate between features and training."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from premia.functions.prices import round_exact
from premia.operators.contract import (
    FEATURE_TYPES,
    ContractViolation,
    coerce,
    cross_row_failures,
    feature_failures,
    feature_violations,
    raise_on_failures,
    retention,
    row_breaks,
    row_checks,
    schema_issues,
)
from premia.sources.writers import Store, publish_all
from premia.spec import MIN_RETENTION_PCT, FeatureSpec


@dataclass(frozen=True)
class Validation:
    """Coerced features, every failure found, and the failing rows."""

    features: DataFrame
    failures: DataFrame
    violations: DataFrame


def validate_features(features: DataFrame, spec: FeatureSpec = FeatureSpec()) -> Validation:
    """All checks of the feature contract, lazily."""
    typed = coerce(features, FEATURE_TYPES)
    columns = ["sale_id", "shoe_id", "sale_date"]
    return Validation(
        typed,
        feature_failures(typed, spec),
        feature_violations(row_breaks(typed, spec, columns), spec, columns),
    )


def validated(features: DataFrame, spec: FeatureSpec = FeatureSpec()) -> DataFrame:
    """The coerced features, or an error that lists everything wrong with them."""
    issues = schema_issues(features, FEATURE_TYPES)
    shape = [f"[{r['column']}] {r['issue']}" for r in issues.collect()]
    if shape:
        raise ContractViolation("contract broken:\n" + "\n".join(shape))
    outcome = validate_features(features, spec)
    raise_on_failures(outcome.failures)
    return outcome.features


def validation_report(sales: DataFrame, features: DataFrame) -> DataFrame:
    """One row: row counts, retention and the number of missing rolling values."""
    gaps = features.agg(F.count_if(F.col("rolling_7d_avg_premium").isNull()).alias("rolling_null_rows"))
    return retention(sales, features).select(
        F.col("input_rows").alias("input_row_count"),
        F.col("output_rows").alias("output_row_count"),
        round_exact(F.col("retention_pct"), 2).alias("row_retention_pct"),
        F.lit(MIN_RETENTION_PCT).alias("min_row_retention_pct"),
        F.lit("passed").alias("status"),
        gaps.scalar().alias("rolling_null_rows"),
    )


def require_retention(sales: DataFrame, features: DataFrame) -> float:
    """The kept share in percent; below the floor the feature job lost data and the run fails."""
    row = retention(sales, features).first()
    return retained_pct(row["input_rows"], row["output_rows"])


def retained_pct(n_in: int, n_out: int) -> float:
    kept = 100.0 * n_out / n_in if n_in else 0.0
    if kept < MIN_RETENTION_PCT:
        raise ContractViolation(f"kept {n_out} of {n_in} rows ({kept:.1f}%), below {MIN_RETENTION_PCT:.0f}%")
    return kept


def run_validation(
    store: Store, spark, run_date: str, spec: FeatureSpec = FeatureSpec(), features: DataFrame | None = None, keep_refused: bool = False
) -> str:
    """Check one run's features and publish them with a report; nothing of a refused run is visible in the validated zone.

    ``features`` may be a plan (by default the stored features are read): it is run once, written beside the run and checked on
    the way. Checks across rows then read their columns from what was written. Failing rows of a refused run, with the checks they
    break, go to the failures zone. With ``keep_refused`` all rows of a refused run go there too, as table
    ``features``, instead of being removed.
    """
    if features is None:
        features = store.read(spark, "features", "features", run_date)
    shape = sorted(set(FEATURE_TYPES) ^ set(features.columns))
    if shape:
        issues = schema_issues(features.limit(0), FEATURE_TYPES).collect()
        raise ContractViolation("contract broken:\n" + "\n".join(f"[{r['column']}] {r['issue']}" for r in issues))
    lossy = Observation()
    watched = features.observe(lossy, *(
        F.count_if(F.col(c).isNotNull() & F.col(c).try_cast(t).isNull()).alias(c) for c, t in FEATURE_TYPES.items()
    ))
    checks = row_checks(spec)
    metrics = {f"check_{i}": F.count_if(c.broken) for i, c in enumerate(checks)}
    metrics["rolling_null_rows"] = F.count_if(F.col("rolling_7d_avg_premium").isNull())
    staged = store.stage(coerce(watched, FEATURE_TYPES), "validated", "features", run_date, metrics)
    report = {}

    def check() -> None:
        lines = [f"[{c}] not coercible: {n} row(s)" for c, n in lossy.get.items() if n]
        lines += [f"[{c.column or '<row>'}] {c.name}: {staged.metrics[f'check_{i}']} row(s)" for i, c in enumerate(checks) if staged.metrics[f"check_{i}"]]
        written = spark.read.parquet(staged.path)
        lines += [f"[{r['column'] or '<row>'}] {r['check']}: {r['n']} row(s)" for r in cross_row_failures(written, spec).collect()]
        if lines:
            columns = ["sale_id", "shoe_id", "sale_date"]
            broken = feature_violations(row_breaks(written, spec, columns), spec, columns)
            store.write(broken, "failures", "feature_violations", run_date)
            store.write_report(spark, {"run_date": run_date, "failures": lines}, "failures", "failure_report", run_date)
            raise ContractViolation("contract broken:\n" + "\n".join(lines))
        n_in, n_out = store.read(spark, "raw", "sales", run_date).count(), staged.metrics["rows"]
        kept = retained_pct(n_in, n_out)
        report.update(
            input_row_count=n_in, output_row_count=n_out, row_retention_pct=round(kept, 2), min_row_retention_pct=MIN_RETENTION_PCT,
            status="passed", rolling_null_rows=staged.metrics["rolling_null_rows"],
        )

    def check_or_keep() -> None:
        try:
            check()
        except ContractViolation:
            if keep_refused:
                replace(staged, target=store.run_path("failures", "features", run_date)).publish()
            raise

    publish_all([staged], check_or_keep)
    store.write_report(spark, report, "validated", "validation_report", run_date)
    return staged.target
