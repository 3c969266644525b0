"""Linear regression, scoring and error measures."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import asdict, dataclass
from functools import reduce
from operator import add

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from premia.functions.prices import nan_to_null, round_exact
from premia.operators.moments import Moments, moments, moments_by
from premia.operators.prep import Preprocessing


@dataclass(frozen=True)
class LinearModel:
    """Coefficients over the standardised features."""

    preprocessing: Preprocessing
    coefficients: list[float]
    intercept: float

    def prediction(self) -> Column:
        terms = (
            F.lit(w) * self.preprocessing.scaled(f)
            for f, w in zip(self.preprocessing.features, self.coefficients)
        )
        return reduce(add, terms, F.lit(self.intercept))

    def score(self, rows: DataFrame, name: str = "predicted_premium") -> DataFrame:
        return rows.withColumn(name, self.prediction())

    def to_dict(self) -> dict:
        return asdict(self)


def linear_of(state: Moments, features: Sequence[str]) -> LinearModel:
    """The least-squares model of the rows that a state has seen."""
    preprocessing = state.preprocessing(features)
    weights, intercept = state.least_squares(preprocessing)
    return LinearModel(preprocessing, weights.tolist(), intercept)


def fit_linear(train: DataFrame, features: Sequence[str], target: str) -> LinearModel:
    """Least squares on the filled and standardised features, from one pass over the rows.

    Gaps take the mean over all rows; rows without a target count for that only.
    """
    return linear_of(moments(train, features, target), features)


def fit_linear_by(train: DataFrame, features: Sequence[str], target: str, keys: Sequence[str]) -> DataFrame:
    """A model per group: (keys, n, term, weight), weights per unit of the feature, and the intercept. Groups without a target have no rows."""
    size = len(features) + 1
    fields = [train.schema[k] for k in keys]
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in fields), "n long, term string, weight double"])

    def solve(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = []
            for *key, flat in frame.itertuples(index=False, name=None):
                state = Moments.unflat(flat, size)
                if not state.pairs[-1, -1]:
                    continue
                model = linear_of(state, features)
                slopes = [w / s for w, s in zip(model.coefficients, model.preprocessing.std)]
                start = model.intercept - sum(w * m for w, m in zip(slopes, model.preprocessing.mean))
                rows += [(*key, int(state.pairs[-1, -1]), term, weight) for term, weight in [*zip(features, slopes), ("intercept", start)]]
            yield pd.DataFrame(rows, columns=[*keys, "n", "term", "weight"])

    return moments_by(train, features, target, keys).mapInPandas(solve, schema)


def rmse(predicted: Column, actual: Column) -> Column:
    """Root mean squared error, as an aggregate."""
    return F.sqrt(F.avg(F.pow(predicted - actual, F.lit(2.0))))


def prediction_table(scored: DataFrame, keys: Sequence[str], target: str) -> DataFrame:
    """Present keys, the prediction, and the true value where the batch carries it."""
    kept = [k for k in keys if k in scored.columns]
    actual = [F.col(target).cast("double").alias("actual_premium")] if target in scored.columns else []
    return scored.select(*kept, "predicted_premium", *actual)


def scoring_report(predictions: DataFrame) -> DataFrame:
    """One row: the number of scored rows and, given true values, the error to 5 places."""
    measures = [F.count("*").alias("n_scored")]
    if "actual_premium" in predictions.columns:
        error = rmse(F.col("predicted_premium"), F.col("actual_premium"))
        measures.append(round_exact(error, 5).alias("rmse_vs_actual"))
    return predictions.agg(*measures)


# What a feature record must hold to be scored; the other two inputs may be missing.
RECORD_REQUIRED = [
    "days_since_release",
    "size_us",
    "retail_price",
    "size_premium",
    "release_type_encoded",
    "brand_avg_premium",
]
RECORD_POSITIVE = ["size_us", "retail_price"]


def record_is_valid() -> Column:
    """True for a record whose required inputs are present and whose size and retail are above 0. NaN is missing."""
    present = [nan_to_null(F.col(c).cast("double")).isNotNull() for c in RECORD_REQUIRED]
    positive = [nan_to_null(F.col(c).cast("double")) > 0 for c in RECORD_POSITIVE]
    return F.coalesce(reduce(Column.__and__, present + positive), F.lit(False))


def split_records(records: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Records to score, and records refused."""
    return records.where(record_is_valid()), records.where(~record_is_valid())
