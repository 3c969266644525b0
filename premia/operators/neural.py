"""The premium network: two hidden blocks (linear, batch norm, ReLU, dropout) and a linear output.

Training is synchronous and data-parallel. A step takes a number of mini-batches, each normalised by its own moments; tasks
add up their gradients and batch moments, Spark hands the sums to the driver, which makes one Adam step with their mean over all rows. Which
rows form a batch is a function of the rows alone, so a step is the same however they are spread over tasks. Rows never
leave the executors; the driver holds one state of fixed size (a few thousand numbers, set by the network's shape).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import asdict, dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from premia.operators.prep import Preprocessing
from premia.session import materialize, release, scratch_path
from premia.spec import TRAINING_SEED

# --- Fixed values: batch norm and Adam defaults -------------------------------------------------
BN_EPS = 1e-5
BN_MOMENTUM = 0.1
ADAM_BETAS = (0.9, 0.999)
ADAM_EPS = 1e-8


# Steps of an epoch at most, unless the caller sets the mini-batches of a step: more rows make more batches a step.
MOST_STEPS = 50


@dataclass(frozen=True)
class NetworkSpec:
    """Hyperparameters. The defaults are fixed values."""

    hidden_dim: int = 64
    dropout_rate: float = 0.1
    learning_rate: float = 1e-3
    batch_size: int = 256
    num_epochs: int = 20


def parameter_shapes(inputs: int, hidden: int) -> dict[str, tuple[int, ...]]:
    """Trained parameters, then the running batch-norm moments."""
    return {
        "w1": (inputs, hidden), "b1": (hidden,), "g1": (hidden,), "s1": (hidden,),
        "w2": (hidden, hidden), "b2": (hidden,), "g2": (hidden,), "s2": (hidden,),
        "w3": (hidden, 1), "b3": (1,),
        "rm1": (hidden,), "rv1": (hidden,), "rm2": (hidden,), "rv2": (hidden,),
    }


Params = dict[str, np.ndarray]


def initial_parameters(inputs: int, hidden: int, seed: int = TRAINING_SEED) -> Params:
    """Uniform weights scaled by fan-in, unit batch-norm gains and variances."""
    rng = np.random.default_rng(seed)
    fan_in = {"w1": inputs, "b1": inputs, "w2": hidden, "b2": hidden, "w3": hidden, "b3": hidden}
    params = {}
    for name, shape in parameter_shapes(inputs, hidden).items():
        if name in fan_in:
            limit = 1.0 / np.sqrt(fan_in[name])
            params[name] = rng.uniform(-limit, limit, shape)
        else:
            params[name] = np.ones(shape) if name.startswith(("g", "rv")) else np.zeros(shape)
    return params


def flatten(params: Params) -> np.ndarray:
    return np.concatenate([p.ravel() for p in params.values()])


def unflatten(flat: np.ndarray, inputs: int, hidden: int) -> Params:
    params, at = {}, 0
    for name, shape in parameter_shapes(inputs, hidden).items():
        size = int(np.prod(shape))
        params[name] = np.asarray(flat[at : at + size], dtype=float).reshape(shape)
        at += size
    return params


def predict(params: Params, x: np.ndarray) -> np.ndarray:
    """Forward pass for scoring: running moments, no dropout."""
    h = x
    for block in ("1", "2"):
        z = h @ params["w" + block] + params["b" + block]
        z = (z - params["rm" + block]) / np.sqrt(params["rv" + block] + BN_EPS)
        h = np.maximum(z * params["g" + block] + params["s" + block], 0.0)
    return (h @ params["w3"] + params["b3"])[:, 0]


def training_step(params: Params, x: np.ndarray, y: np.ndarray, keep: tuple[np.ndarray, np.ndarray]) -> tuple[float, Params]:
    """Loss and gradients of one mini-batch, with its moments as the gradients of ``rm`` and ``rv``.

    ``keep`` has the dropout factors of both hidden layers.
    """
    n, h, tape, grads = len(x), x, [], {}
    for block, mask in zip("12", keep):
        z = h @ params["w" + block] + params["b" + block]
        mean, var = z.mean(axis=0), z.var(axis=0)
        grads["rm" + block], grads["rv" + block] = mean, var * n / max(n - 1, 1)
        scale = 1.0 / np.sqrt(var + BN_EPS)
        normed = (z - mean) * scale
        pre = normed * params["g" + block] + params["s" + block]
        open_ = (pre > 0) * mask
        tape.append((block, h, normed, scale, open_))
        h = pre * open_
    error = (h @ params["w3"] + params["b3"])[:, 0] - y
    d_out = (2.0 / n) * error[:, None]
    grads["w3"], grads["b3"] = h.T @ d_out, d_out.sum(axis=0)
    d_h = d_out @ params["w3"].T
    for block, h_in, normed, scale, open_ in reversed(tape):
        d_pre = d_h * open_
        grads["g" + block] = (d_pre * normed).sum(axis=0)
        grads["s" + block] = d_pre.sum(axis=0)
        d_norm = d_pre * params["g" + block]
        d_z = scale * (d_norm - d_norm.mean(axis=0) - normed * (d_norm * normed).mean(axis=0))
        grads["w" + block] = h_in.T @ d_z
        grads["b" + block] = d_z.sum(axis=0)
        d_h = d_z @ params["w" + block].T
    return float((error**2).mean()), grads


def dropout_factors(keys: np.ndarray, width: int, rate: float, salt: int) -> np.ndarray:
    """0 for units to leave out, else 1 / (1 - rate); a function of the row's key, the unit and ``salt`` alone."""
    if not rate:
        return np.ones((len(keys), width))
    units = (np.arange(width, dtype=np.uint64) + np.uint64(1 + salt * width)) * np.uint64(0x9E3779B97F4A7C15)
    mixed = keys[:, None] ^ units
    for _ in range(2):
        mixed ^= mixed >> np.uint64(31)
        mixed *= np.uint64(0xD6E8FEB86659FD93)
    uniform = ((mixed ^ (mixed >> np.uint64(32))) >> np.uint64(11)) / 2.0**53
    return (uniform >= rate) / (1.0 - rate)


def adam_step(params: Params, grads: Params, m: Params, v: Params, step: int, rate: float) -> None:
    """One Adam update, in place; running moments move towards the batch's."""
    b1, b2 = ADAM_BETAS
    for name, g in grads.items():
        if name[0] == "r":
            params[name] = (1 - BN_MOMENTUM) * params[name] + BN_MOMENTUM * g
            continue
        m[name] = b1 * m[name] + (1 - b1) * g
        v[name] = b2 * v[name] + (1 - b2) * g * g
        m_hat, v_hat = m[name] / (1 - b1**step), v[name] / (1 - b2**step)
        params[name] = params[name] - rate * m_hat / (np.sqrt(v_hat) + ADAM_EPS)


@dataclass
class TrainingState:
    """Parameters, Adam moments and step count, as flat vectors of fixed size."""

    params: np.ndarray
    m: np.ndarray
    v: np.ndarray
    steps: int


@dataclass(frozen=True)
class NeuralModel:
    """A trained network with its preprocessing."""

    preprocessing: Preprocessing
    spec: NetworkSpec
    weights: list[float]

    def score(self, rows: DataFrame, name: str = "predicted_premium") -> DataFrame:
        """The rows plus a prediction, computed per Arrow batch with broadcast weights."""
        inputs, hidden = len(self.preprocessing.features), self.spec.hidden_dim
        shared = rows.sparkSession.sparkContext.broadcast(np.asarray(self.weights))

        @F.pandas_udf("double")
        def forward(batches: Iterator[pd.DataFrame]) -> Iterator[pd.Series]:
            params = unflatten(shared.value, inputs, hidden)
            for batch in batches:
                yield pd.Series(predict(params, batch.to_numpy(dtype=np.float64)))

        # A column per feature travels as plain doubles; an array column would be an object per row.
        features = F.struct(*(self.preprocessing.scaled(f).alias(f"f{i}") for i, f in enumerate(self.preprocessing.features)))
        return rows.withColumn(name, forward(features))

    def to_dict(self) -> dict:
        return asdict(self)


def fit_network(
    train: DataFrame,
    validation: DataFrame,
    preprocessing: Preprocessing,
    target: str,
    spec: NetworkSpec = NetworkSpec(),
    workers: int | None = None,
    seed: int = TRAINING_SEED,
) -> tuple[NeuralModel, list[dict]]:
    """Train the network. Returns it with (epoch, train_loss, val_loss, val_rmse) per epoch.

    ``workers`` is the number of mini-batches of a step, by default as many as keep an epoch at ``MOST_STEPS`` steps; with one it
    is plain mini-batch training. The result depends on it, but not on the number of tasks. The prepared rows are stored once; an epoch
    deals them out anew and checks that it has seen all of them. ``validation`` is scored in every epoch, so it should be a stored table.
    """
    inputs, hidden = len(preprocessing.features), spec.hidden_dim
    state = initial_state(flatten(initial_parameters(inputs, hidden, seed)))
    ready, rows = training_rows(train, preprocessing, target)
    workers = workers or -(-rows // (spec.batch_size * MOST_STEPS))
    steps = max(1, rows // (spec.batch_size * workers))
    history = []
    for epoch in range(spec.num_epochs):
        chosen = F.pmod(F.xxhash64("key", F.lit(epoch), F.lit(seed)), F.lit(steps * workers))
        state, train_loss = run_epoch(ready, rows, chosen, steps, workers, state, epoch, inputs, spec)
        model = NeuralModel(preprocessing, spec, state.params.tolist())
        val_loss = mean_squared_error(model.score(validation), target)
        history.append(
            {
                "epoch": epoch,
                "train_loss": train_loss,
                "val_loss": val_loss,
                "val_rmse": None if val_loss is None else val_loss**0.5,
            }
        )
    return model, history


def initial_state(params: np.ndarray) -> TrainingState:
    return TrainingState(params, np.zeros_like(params), np.zeros_like(params), 0)


def training_rows(train: DataFrame, preprocessing: Preprocessing, target: str, key: Column | None = None) -> tuple[DataFrame, int]:
    """The rows with a target as (x, y, key), stored, and their number. The key stands for a row, by default for its values."""
    ready = train.where(F.col(target).isNotNull())
    columns = [preprocessing.vector().alias("x"), F.col(target).cast("double").alias("y")]
    ready = ready.select(*columns, *([] if key is None else [key.alias("key")]))
    ready = materialize(ready if key is not None else ready.withColumn("key", F.xxhash64("x", "y")), "training-rows")
    rows = ready.count()
    if not rows:
        raise ValueError("there are no rows to train on")
    return ready, rows


def mean_squared_error(scored: DataFrame, target: str) -> float | None:
    return scored.agg(F.avg(F.pow(F.col("predicted_premium") - F.col(target), F.lit(2.0)))).first()[0]


def run_epoch(
    ready: DataFrame, rows: int, chosen: Column, steps: int, workers: int, state: TrainingState, epoch: int, inputs: int, spec: NetworkSpec
) -> tuple[TrainingState, float]:
    """One pass over the training rows: the new state and the mean loss.

    ``chosen`` is the number of a row's mini-batch, below ``steps * workers``; each step takes the next ``workers`` of them. A batch
    becomes one row of a table stored by step, its rows ordered by key, so a step reads its own batches only.
    """
    spark = ready.sparkSession
    dealt = ready.select(chosen.alias("batch"), "key", "x", "y").groupBy("batch").agg(F.sort_array(F.collect_list(F.struct("key", "y", "x"))).alias("rows"))
    path = scratch_path(spark, "batches")
    dealt.withColumn("step", F.floor(F.col("batch") / workers)).write.partitionBy("step").parquet(path)
    schema = "batch long, rows array<struct<key:bigint, y:double, x:array<double>>>"
    hidden, seen, loss_sum = spec.hidden_dim, 0.0, 0.0
    params = unflatten(state.params, inputs, hidden)
    m, v, made = unflatten(state.m, inputs, hidden), unflatten(state.v, inputs, hidden), state.steps
    written = {int(r["step"]) for r in spark.read.parquet(path).select("step").distinct().collect()}
    for step in range(steps):
        if step not in written:
            continue
        batches = spark.read.schema(schema).parquet(f"{path}/step={step}")
        total = batches.mapInArrow(_gradients(flatten(params), inputs, spec, epoch), "sums array<double>")
        sums = np.sum([r["sums"] for r in total.collect()], axis=0)
        n = sums[0]
        made += 1
        adam_step(params, unflatten(sums[2:] / n, inputs, hidden), m, v, made, spec.learning_rate)
        seen, loss_sum = seen + n, loss_sum + sums[1]
    release(spark, path)
    if seen != rows:
        raise RuntimeError(f"an epoch has seen {seen:.0f} of {rows} training rows")
    return TrainingState(flatten(params), flatten(m), flatten(v), made), float(loss_sum / rows)


def _gradients(flat: np.ndarray, inputs: int, spec: NetworkSpec, epoch: int):
    """Sums of a task's batches: rows, loss, and gradients, weighted by rows."""

    def add(records: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        params, sums = unflatten(flat, inputs, spec.hidden_dim), np.zeros(len(flat) + 2)
        for record in records:
            lists = record.column(1)
            key, y, x = lists.flatten().flatten()
            ends = np.asarray(lists.offsets).astype(np.int64) - lists.offsets[0].as_py()
            x = np.asarray(x.flatten(), float).reshape(-1, inputs)
            y, key = y.to_numpy(zero_copy_only=False), key.to_numpy(zero_copy_only=False).view(np.uint64)
            for a, b in zip(ends[:-1], ends[1:]):
                keep = tuple(dropout_factors(key[a:b], spec.hidden_dim, spec.dropout_rate, 2 * epoch + layer) for layer in (0, 1))
                loss, grads = training_step(params, x[a:b], y[a:b], keep)
                sums += (b - a) * np.concatenate([[1.0, loss], flatten({name: grads[name] for name in params})])
        yield pa.RecordBatch.from_arrays([pa.array([sums], pa.list_(pa.float64()))], names=["sums"])

    return add
