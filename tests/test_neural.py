"""The network against finite differences, and its training on Spark."""

from __future__ import annotations

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from premia.operators.neural import (
    NetworkSpec,
    adam_step,
    dropout_factors,
    fit_network,
    flatten,
    initial_parameters,
    predict,
    training_step,
    unflatten,
)
from premia.operators.prep import fit_preprocessing, temporal_split
from premia.plans.training import load_model, save_model, train_network
from premia.sources.writers import Store
from premia.spec import MODEL_FEATURES


def test_gradients_equal_finite_differences():
    rng = np.random.default_rng(3)
    params = {k: v + rng.normal(0, 0.1, v.shape) for k, v in initial_parameters(3, 5).items()}
    params.update({k: np.abs(v) + 0.5 for k, v in params.items() if k.startswith("rv")})
    x, y, keys = rng.normal(size=(40, 3)), rng.normal(size=40), rng.integers(0, 2**63, 40).astype(np.uint64)
    keep = tuple(dropout_factors(keys, 5, 0.3, layer) for layer in (0, 1))

    def loss_of(candidate):
        return training_step(candidate, x, y, keep)[0]

    _, grads = training_step(params, x, y, keep)
    assert set(grads) == set(params)
    for name, grad in grads.items():
        if name.startswith("r"):
            continue
        at = tuple(0 for _ in grad.shape)
        up, down = ({k: v.copy() for k, v in params.items()} for _ in range(2))
        up[name][at] += 1e-6
        down[name][at] -= 1e-6
        assert grad[at] == pytest.approx((loss_of(up) - loss_of(down)) / 2e-6, abs=1e-5), name


def test_dropout_keeps_the_expected_share():
    keys = np.random.default_rng(0).integers(0, 2**63, 4000).astype(np.uint64)
    factors = dropout_factors(keys, 20, 0.25, 3)
    assert set(np.unique(factors)) == {0.0, 1 / 0.75} and abs(factors.mean() - 1) < 0.02
    assert (dropout_factors(keys[::-1], 20, 0.25, 3) == factors[::-1]).all()
    assert (dropout_factors(keys, 20, 0.25, 4) != factors).any()


def labelled(spark, n=3000):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(n, len(MODEL_FEATURES)))
    y = np.maximum(x[:, 0], 0) - 0.5 * x[:, 1] * (x[:, 2] > 0)
    rows = [(i, dt.datetime(2021 + i % 3, 1, 1), *map(float, x[i]), float(y[i])) for i in range(n)]
    doubles = ", ".join(f"{c} DOUBLE" for c in [*MODEL_FEATURES, "price_premium"])
    return spark.createDataFrame(rows, f"sale_id LONG, sale_date TIMESTAMP_NTZ, {doubles}")


def test_training_learns_and_scores_alike(spark, tmp_path):
    rows = labelled(spark).withColumn(
        "rolling_7d_avg_premium", F.when(F.col("sale_id") % 7 > 0, F.col("rolling_7d_avg_premium"))
    )
    spec = NetworkSpec(hidden_dim=16, dropout_rate=0.0, learning_rate=0.03, batch_size=160, num_epochs=6)
    run = train_network(rows, 2023, spec, workers=1)
    assert len(run.history) == 6
    assert run.history[-1]["train_loss"] < run.history[0]["train_loss"] / 3
    assert run.val_rmse < 0.3
    path = save_model(Store(str(tmp_path)), spark, run, "2025-01-01", "net")
    model = load_model(spark, path)
    assert model == run.model

    sample = model.score(rows.orderBy("sale_id").limit(50)).orderBy("sale_id").collect()
    p = model.preprocessing
    raw = np.array([[np.nan if r[f] is None else r[f] for f in MODEL_FEATURES] for r in sample])
    x = (np.where(np.isnan(raw), p.impute, raw) - p.mean) / p.std
    expected = predict(unflatten(np.array(model.weights), len(MODEL_FEATURES), 16), x)
    np.testing.assert_allclose([r["predicted_premium"] for r in sample], expected, rtol=1e-9)


@pytest.mark.parametrize("partitions", [1, 7])
def test_full_batches_equal_plain_training(spark, partitions):
    rows = labelled(spark, 300)
    train, validation = temporal_split(rows, "sale_date", 2023)
    transform = fit_preprocessing(train, MODEL_FEATURES)
    spec = NetworkSpec(hidden_dim=4, dropout_rate=0.0, batch_size=10_000, num_epochs=2)
    model, history = fit_network(train.repartition(partitions), validation, transform, "price_premium", spec)

    data = train.select(transform.vector().alias("x"), "price_premium").collect()
    x, y = np.array([r["x"] for r in data]), np.array([r["price_premium"] for r in data])
    params = initial_parameters(len(MODEL_FEATURES), 4)
    m = {k: np.zeros_like(v) for k, v in params.items()}
    v = {k: np.zeros_like(w) for k, w in params.items()}
    ones = (np.ones((len(x), 4)),) * 2
    for step in (1, 2):
        loss, grads = training_step(params, x, y, ones)
        adam_step(params, grads, m, v, step, spec.learning_rate)
        assert history[step - 1]["train_loss"] == pytest.approx(loss, rel=1e-9)
    np.testing.assert_allclose(model.weights, flatten(params), rtol=1e-6, atol=1e-9)


def test_results_do_not_depend_on_the_tasks(spark):
    rows = labelled(spark, 500)
    train, validation = temporal_split(rows, "sale_date", 2023)
    transform = fit_preprocessing(train, MODEL_FEATURES)
    spec = NetworkSpec(hidden_dim=6, dropout_rate=0.2, batch_size=100, num_epochs=2)
    runs = [fit_network(train.repartition(n), validation, transform, "price_premium", spec, workers=2) for n in (1, 7)]
    np.testing.assert_allclose(runs[0][0].weights, runs[1][0].weights, rtol=1e-9, atol=1e-9)
    assert [h["train_loss"] for h in runs[0][1]] == pytest.approx([h["train_loss"] for h in runs[1][1]], rel=1e-9)


def test_no_rows_to_train_on(spark):
    rows = labelled(spark, 10).withColumn("price_premium", F.lit(None).cast("double"))
    with pytest.raises(ValueError, match="no rows"):
        fit_network(rows, rows, fit_preprocessing(rows, MODEL_FEATURES), "price_premium", NetworkSpec(num_epochs=1))
