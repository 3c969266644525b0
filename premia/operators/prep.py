"""Temporal split, imputation and standardisation, fitted on the training side only."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import asdict, dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from premia.functions.prices import nan_to_null


def temporal_split(rows: DataFrame, instant: str, year: int) -> tuple[DataFrame, DataFrame]:
    """Rows before ``year`` for training, rows from it on for validation."""
    sold_in = F.year(instant)
    return rows.where(sold_in < year), rows.where(sold_in >= year)


def split_sizes(rows: DataFrame, instant: str, year: int) -> DataFrame:
    """One row: how many rows fall on each side."""
    sold_in = F.year(instant)
    return rows.agg(
        F.count_if(sold_in < year).alias("n_train"), F.count_if(sold_in >= year).alias("n_validation")
    )


def require_both_sides(rows: DataFrame, instant: str, year: int) -> tuple[int, int]:
    """The two side sizes; an empty side is an error, since the run would measure nothing."""
    n_train, n_validation = split_sizes(rows, instant, year).first()
    if not n_train or not n_validation:
        raise ValueError(
            f"splitting at {year} leaves an empty side: {n_train} training, {n_validation} validation rows"
        )
    return n_train, n_validation


@dataclass(frozen=True)
class Preprocessing:
    """Fill-in value, mean and spread per feature: the one transform of training and scoring."""

    features: list[str]
    impute: list[float]
    mean: list[float]
    std: list[float]

    def filled(self, feature: str) -> Column:
        at = self.features.index(feature)
        return F.coalesce(nan_to_null(F.col(feature).cast("double")), F.lit(self.impute[at]))

    def scaled(self, feature: str) -> Column:
        """The standardised feature as a column expression."""
        at = self.features.index(feature)
        return (self.filled(feature) - F.lit(self.mean[at])) / F.lit(self.std[at])

    def vector(self) -> Column:
        """All standardised features, in order, as one array."""
        return F.array(*(self.scaled(f) for f in self.features))

    def apply(self, rows: DataFrame) -> DataFrame:
        """The rows with every feature replaced by its standardised value."""
        return rows.withColumns({f: self.scaled(f) for f in self.features})

    def to_dict(self) -> dict:
        return asdict(self)


def preprocessing_stats(train: DataFrame, features: Sequence[str]) -> DataFrame:
    """(feature, impute, mean, std) in one pass.

    Filling gaps with the mean leaves the mean as it is and adds no squared deviations, so the spread
    after filling follows from the spread of the given values: ``stddev_pop * sqrt(given / all)``.
    """
    aggregates = []
    for f in features:
        value = nan_to_null(F.col(f).cast("double"))
        spread = F.stddev_pop(value) * F.sqrt(F.try_divide(F.count(value), F.count("*")))
        aggregates.append(
            F.struct(
                F.lit(f).alias("feature"),
                F.coalesce(F.avg(value), F.lit(0.0)).alias("impute"),
                F.coalesce(F.avg(value), F.lit(0.0)).alias("mean"),
                F.coalesce(F.nullif(spread, F.lit(0.0)), F.lit(1.0)).alias("std"),
            )
        )
    return train.agg(F.array(*aggregates).alias("stats")).select(F.inline("stats"))


def fit_preprocessing(train: DataFrame, features: Sequence[str]) -> Preprocessing:
    """Fit on the training rows."""
    by_feature = {r["feature"]: r for r in preprocessing_stats(train, features).collect()}
    return Preprocessing(
        list(features),
        *([float(by_feature[f][part]) for f in features] for part in ("impute", "mean", "std")),
    )
