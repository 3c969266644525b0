"""A data contract: named row checks, all evaluated before anything fails.

A check is a boolean Column that is true where a row breaks it. Checks across rows (uniqueness, history)
first attach what they need with an aggregate and a join, so all checks are counted in one pass.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from premia.functions.prices import nan_to_null
from premia.operators.groups import attach, attach_group_min
from premia.spec import CANONICAL_SCHEMAS, FEATURE_TABLE_COLUMNS, FeatureSpec


class ContractViolation(Exception):
    """The data breaks its contract; the message lists every failed check and its rows."""


@dataclass(frozen=True)
class Check:
    """``broken`` is true for rows that break the check. ``column`` is None for cross-column checks."""

    column: str | None
    name: str
    broken: Column

    @property
    def label(self) -> str:
        return f"{self.column or '<row>'}:{self.name}"


def missing(column: str) -> Column:
    """NULL, or NaN in a floating-point column."""
    floating = F.typeof(column).isin("double", "float")
    return F.col(column).isNull() | (floating & (F.col(column).cast("string") == "NaN"))


def not_null(column: str) -> Check:
    return Check(column, "not_null", missing(column))


def above(column: str, bound: float) -> Check:
    """NaN breaks the check: Spark orders it above all numbers."""
    return Check(column, f"> {bound:g}", ~(F.col(column) > F.lit(bound)) | missing_number(column))


def at_least(column: str, bound: float) -> Check:
    return Check(column, f">= {bound:g}", ~(F.col(column) >= F.lit(bound)) | missing_number(column))


def missing_number(column: str) -> Column:
    """True for NaN; NULL for NULL, which breaks no comparison."""
    return F.col(column) > F.lit(float("inf"))


def in_range(column: str, low: float, high: float) -> Check:
    return Check(column, f"in [{low:g}, {high:g}]", ~F.col(column).between(F.lit(low), F.lit(high)))


def is_in(column: str, allowed: Sequence) -> Check:
    listed = ", ".join(str(a) for a in allowed)
    return Check(column, f"in {{{listed}}}", ~F.col(column).isin(*allowed))


def unique(column: str) -> Check:
    """Needs ``with_copies(rows, column)``; every copy breaks the check."""
    return Check(column, "unique", F.col(f"_copies_{column}") > 1)


def null_iff_short_history(value: str, instant: str, days: int) -> Check:
    """Needs ``with_first(rows, key, instant)``: the value is NULL exactly below ``days`` of history."""
    short = F.datediff(F.col(instant), F.col(f"_first_{instant}")) < days
    return Check(None, f"{value} is null iff history < {days} days", missing(value) != short)


def with_copies(rows: DataFrame, column: str) -> DataFrame:
    """Adds how often the value of ``column`` occurs. Only repeated values enter the join."""
    repeated = (
        rows.groupBy(column).agg(F.count("*").alias(f"_copies_{column}"))
        .where(F.col(f"_copies_{column}") > 1)
    )
    return attach(rows, repeated, [column])


def with_first(rows: DataFrame, key: str, instant: str) -> DataFrame:
    """Adds the first instant of the row's key."""
    return attach_group_min(rows, [key], instant, f"_first_{instant}")


def feature_checks(spec: FeatureSpec) -> list[Check]:
    """The contract of the feature table."""
    nullable = {"rolling_7d_avg_premium", "search_index_7d_pre_drop"}
    required = [not_null(c) for c in FEATURE_TABLE_COLUMNS if c not in nullable]
    return [
        *required,
        unique("sale_id"),
        above("size_us", 0),
        above("retail_price", 0),
        above("sale_price", 0),
        is_in("release_type", list(spec.release_type_ranks)),
        is_in("release_type_encoded", list(spec.release_type_ranks.values())),
        in_range("price_premium", *spec.premium_bounds),
        at_least("days_since_release", spec.min_days_since_release),
        null_iff_short_history("rolling_7d_avg_premium", "sale_date", spec.rolling_days),
    ]


def prepare_feature_checks(features: DataFrame) -> DataFrame:
    """The features plus the helper columns the cross-row checks read."""
    return with_first(with_copies(features, "sale_id"), "shoe_id", "sale_date")


# The types the feature table is coerced to before it is checked.
FEATURE_TYPES = {
    "sale_id": "long", "shoe_id": "long", "brand": "string", "size_us": "double",
    "sale_date": "timestamp_ntz", "release_date": "timestamp_ntz", "retail_price": "double",
    "sale_price": "double", "release_type": "string", "price_premium": "double",
    "days_since_release": "long", "size_premium": "double", "release_type_encoded": "long",
    "rolling_7d_avg_premium": "double", "search_index_7d_pre_drop": "double",
    "brand_avg_premium": "double",
}


def schema_issues(rows: DataFrame, types: dict[str, str]) -> DataFrame:
    """(column, issue, n): missing and unexpected columns, and values that do not fit the type.

    The column set must match exactly. A column whose values all fit after a cast is no issue.
    """
    present = rows.columns
    structural = [(c, "missing", None) for c in types if c not in present]
    structural += [(c, "unexpected", None) for c in present if c not in types]
    shape = rows.sparkSession.createDataFrame(structural, "column STRING, issue STRING, n LONG")
    shared = [c for c in types if c in present]
    if not shared:
        return shape
    lost = {
        c: F.count_if(F.col(c).isNotNull() & F.col(c).try_cast(types[c]).isNull()) for c in shared
    }
    counted = rows.agg(*(n.alias(c) for c, n in lost.items()))
    pairs = F.array(
        *(F.struct(F.lit(c).alias("column"), F.col(c).alias("n")) for c in shared)
    )
    values = counted.select(F.inline(pairs)).where("n > 0")
    return shape.unionByName(values.withColumn("issue", F.lit("not coercible")), allowMissingColumns=True)


def coerce(rows: DataFrame, types: dict[str, str]) -> DataFrame:
    """The declared columns in their declared types, NaN as NULL."""
    cast = {c: F.col(c).try_cast(t) for c, t in types.items()}
    return rows.select(*((nan_to_null(x) if types[c] == "double" else x).alias(c) for c, x in cast.items()))


def failure_counts(rows: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """(column, check, n) for every check that at least one row breaks, from one pass."""
    counted = rows.agg(
        *(F.count_if(c.broken).alias(f"check_{i}") for i, c in enumerate(checks))
    )
    listed = F.array(
        *(
            F.struct(
                F.lit(c.column).cast("string").alias("column"),
                F.lit(c.name).alias("check"),
                F.col(f"check_{i}").alias("n"),
            )
            for i, c in enumerate(checks)
        )
    )
    return counted.select(F.inline(listed)).where("n > 0")


def repeated_values(rows: DataFrame, column: str) -> DataFrame:
    """One row: how many rows hold a value that occurs more than once. Only the column is shuffled."""
    repeated = rows.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n")).where("n > 1")
    return repeated.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"))


def history_breaks(rows: DataFrame, key: str, instant: str, value: str, days: int) -> DataFrame:
    """One row: how many rows are NULL with enough history, or not NULL with less. Rows are counted by key and day first."""
    counted = rows.groupBy(key, F.to_date(instant).alias("_day"), missing(value).alias("_gap")).agg(F.count("*").alias("_n"))
    dated = attach_group_min(counted, [key], "_day", "_first")
    short = F.datediff("_day", "_first") < days
    return dated.agg(F.coalesce(F.sum(F.when(F.col("_gap") != short, F.col("_n"))), F.lit(0)).alias("n"))


def cross_row_failures(features: DataFrame, spec: FeatureSpec) -> DataFrame:
    """(column, check, n) of the broken checks across rows, from the few columns that each of them reads."""
    history = null_iff_short_history("rolling_7d_avg_premium", "sale_date", spec.rolling_days)
    measured = [
        (unique("sale_id"), repeated_values(features, "sale_id")),
        (history, history_breaks(features, "shoe_id", "sale_date", "rolling_7d_avg_premium", spec.rolling_days)),
    ]
    named = [n.select(F.lit(c.column).cast("string").alias("column"), F.lit(c.name).alias("check"), "n") for c, n in measured]
    return named[0].unionByName(named[1]).where("n > 0")


def row_checks(spec: FeatureSpec) -> list[Check]:
    """The checks of the contract that look at one row."""
    across = {unique("sale_id").label, null_iff_short_history("rolling_7d_avg_premium", "sale_date", spec.rolling_days).label}
    return [c for c in feature_checks(spec) if c.label not in across]


def feature_failures(features: DataFrame, spec: FeatureSpec) -> DataFrame:
    """(column, check, n) of every broken check of the feature contract; rows are not joined to what a check needs."""
    return failure_counts(features, row_checks(spec)).unionByName(cross_row_failures(features, spec))


def violating_rows(rows: DataFrame, checks: Sequence[Check], columns: Sequence[str]) -> DataFrame:
    """The rows that break a check, with the labels of all checks they break."""
    labels = F.array_compact(F.array(*(F.when(c.broken, F.lit(c.label)) for c in checks)))
    return rows.select(*columns, labels.alias("violations")).where(F.size("violations") > 0)


def row_breaks(features: DataFrame, spec: FeatureSpec, columns: Sequence[str]) -> DataFrame:
    """``columns``, the row checks that each row breaks as bits of ``_broken``, and what the checks across rows read.

    Of the rolling mean only whether it is there is kept, so the rows that checks across rows shuffle are narrow.
    """
    bits = [F.when(c.broken, F.lit(1 << i)).otherwise(F.lit(0)) for i, c in enumerate(row_checks(spec))]
    rolling = "rolling_7d_avg_premium"
    keys = dict.fromkeys([*columns, "sale_id", "shoe_id", "sale_date"])
    return features.select(*keys, F.when(~missing(rolling), True).alias(rolling), reduce(Column.bitwiseOR, bits).alias("_broken"))


def feature_violations(breaks: DataFrame, spec: FeatureSpec, columns: Sequence[str]) -> DataFrame:
    """The rows of ``row_breaks`` that break a check of the feature contract, with the labels of all checks they break."""
    bits = {c.label: F.col("_broken").bitwiseAND(1 << i) != 0 for i, c in enumerate(row_checks(spec))}
    checks = [Check(c.column, c.name, bits.get(c.label, c.broken)) for c in feature_checks(spec)]
    return violating_rows(prepare_feature_checks(breaks), checks, columns)


def raise_on_failures(failures: DataFrame) -> None:
    """Fail with all broken checks. The frame has at most one row per check."""
    broken = failures.collect()
    if broken:
        lines = [f"[{r['column'] or '<row>'}] {r['check']}: {r['n']} row(s)" for r in broken]
        raise ContractViolation("contract broken:\n" + "\n".join(lines))


def retention(rows_in: DataFrame, rows_out: DataFrame) -> DataFrame:
    """One row: input and output row counts and the kept share in percent (0 for empty input)."""
    n_in = rows_in.agg(F.count("*").alias("input_rows"), F.lit(0).alias("output_rows"))
    n_out = rows_out.agg(F.lit(0).alias("input_rows"), F.count("*").alias("output_rows"))
    both = n_in.unionByName(n_out).agg(
        F.sum("input_rows").alias("input_rows"), F.sum("output_rows").alias("output_rows")
    )
    pct = F.coalesce(F.try_divide(F.lit(100.0) * F.col("output_rows"), "input_rows"), F.lit(0.0))
    return both.withColumn("retention_pct", pct)


def table_types(table: str) -> dict[str, str]:
    """Declared column types of a canonical table."""
    pairs = (part.strip().split(" ") for part in CANONICAL_SCHEMAS[table].split(","))
    return {name: kind.lower() for name, kind in pairs}
