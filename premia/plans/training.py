"""Fitting and registering a premium model."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from premia.operators.models import LinearModel, linear_of, rmse
from premia.operators.moments import moments
from premia.operators.neural import NetworkSpec, NeuralModel, fit_network
from premia.operators.prep import (
    Preprocessing,
    fit_preprocessing,
    require_both_sides,
    temporal_split,
)
from premia.sources.writers import Store, write_report
from premia.spec import DEFAULT_SPLIT_YEAR, MODEL_FEATURES, TARGET


@dataclass(frozen=True)
class TrainingRun:
    """A fitted model with its validation error and, for the network, its epochs."""

    model: LinearModel | NeuralModel
    val_rmse: float
    n_train: int
    n_validation: int
    history: list[dict]


def prepare(features: DataFrame, split_year: int) -> tuple[DataFrame, DataFrame, Preprocessing]:
    """Training rows, validation rows, and the transform fitted on the training rows."""
    train, validation = temporal_split(features, "sale_date", split_year)
    return train, validation, fit_preprocessing(train, MODEL_FEATURES)


def train_linear(features: DataFrame, split_year: int = DEFAULT_SPLIT_YEAR) -> TrainingRun:
    """Linear baseline: one pass over the training rows, one over the validation rows."""
    train, validation = temporal_split(features, "sale_date", split_year)
    state = moments(train, MODEL_FEATURES, TARGET)
    n_validation = None
    if state.rows:
        model = linear_of(state, MODEL_FEATURES)
        error, n_validation = model.score(validation).agg(rmse(F.col("predicted_premium"), F.col(TARGET)), F.count("*")).first()
    if not n_validation:
        require_both_sides(features, "sale_date", split_year)
    return TrainingRun(model, float(error), int(state.rows), n_validation, history=[])


def train_network(
    features: DataFrame,
    split_year: int = DEFAULT_SPLIT_YEAR,
    spec: NetworkSpec = NetworkSpec(),
    workers: int | None = None,
) -> TrainingRun:
    """The network. ``features`` is read in every epoch, so it should be a stored table."""
    sizes = require_both_sides(features, "sale_date", split_year)
    train, validation, preprocessing = prepare(features, split_year)
    model, history = fit_network(train, validation, preprocessing, TARGET, spec, workers)
    return TrainingRun(model, float(history[-1]["val_rmse"]), *sizes, history=history)


def save_model(store: Store, spark, run: TrainingRun, run_date: str, run_id: str) -> str:
    """One JSON document: the model with the preprocessing it was trained with."""
    kind = "linear" if isinstance(run.model, LinearModel) else "network"
    bundle = {"kind": kind, "run_date": run_date, "val_rmse": run.val_rmse, "model": run.model.to_dict()}
    return write_report(spark, bundle, store.run_path("models", run_id, run_date))


def load_model(spark, path: str) -> LinearModel | NeuralModel:
    """Read a saved model back."""
    import json

    bundle = json.loads(spark.read.text(path, wholetext=True).first()[0])
    parts = bundle["model"]
    preprocessing = Preprocessing(**parts["preprocessing"])
    if bundle["kind"] == "linear":
        return LinearModel(preprocessing, parts["coefficients"], parts["intercept"])
    return NeuralModel(preprocessing, NetworkSpec(**parts["spec"]), parts["weights"])
