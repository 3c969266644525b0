"""Queries over the network: a synchronous training step and scoring, from fixed weights that SQL shares."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from premia.catalog import tables as T
from premia.catalog.features import item_priced
from premia.catalog.models import SPLIT_YEAR
from premia.catalog.registry import query, rounded
from premia.operators.models import prediction_table
from premia.operators.neural import (
    ADAM_BETAS,
    BN_EPS,
    NetworkSpec,
    NeuralModel,
    Params,
    flatten,
    initial_state,
    parameter_shapes,
    run_epoch,
    training_rows,
    unflatten,
)
from premia.operators.prep import fit_preprocessing, temporal_split
from premia.spec import PREDICTION_KEYS, TARGET

_FEATURES = ["days_since_release", "retail_price", "size_gap"]
_GAP = "CASE WHEN size_us < 6 THEN size_us END"
_HIDDEN = 3
_SPEC = NetworkSpec(hidden_dim=_HIDDEN, dropout_rate=0.0)
# Ids of one mini-batch.
_BATCH_IDS = 1024


def fixed_parameters(inputs: int, hidden: int) -> Params:
    """Weights by a rule: small numbers of both signs, gains and variances around 1."""
    shapes = parameter_shapes(inputs, hidden)
    flat = np.array([(7 * i % 23 - 11) / 16 for i in range(sum(int(np.prod(s)) for s in shapes.values()))])
    params = unflatten(flat, inputs, hidden)
    return {name: np.abs(p) / 2 + 0.75 if name.startswith(("g", "rv")) else p for name, p in params.items()}


_PARAMS = fixed_parameters(len(_FEATURES), _HIDDEN)
_UNITS = range(_HIDDEN)


def _weighted(values: list[str], weights: np.ndarray, bias: float) -> str:
    return " + ".join([*(f"{v} * {float(w)!r}::DOUBLE" for v, w in zip(values, weights)), f"{float(bias)!r}::DOUBLE"])


def _columns(name: str, expression) -> str:
    return ", ".join(f"{expression(j)} AS {name}{j}" for j in _UNITS)


_SCALED_SQL = f""",
gapped AS (SELECT *, {_GAP} AS size_gap FROM priced),
known AS (SELECT * FROM gapped WHERE year(sale_date) < {SPLIT_YEAR}),
means AS (SELECT {', '.join(f'avg({f}) AS m{i}' for i, f in enumerate(_FEATURES))} FROM known),
spreads AS (SELECT {', '.join(f'stddev_pop(coalesce({f}, m{i})) AS s{i}' for i, f in enumerate(_FEATURES))} FROM known, means),
scaled AS (SELECT gapped.*, {', '.join(f'(coalesce({f}, m{i}) - m{i}) / s{i} AS x{i}' for i, f in enumerate(_FEATURES))} FROM gapped, means, spreads)"""


def _scored_layer(block: str, values: list[str], name: str) -> str:
    p = _PARAMS

    def unit(j: int) -> str:
        z = _weighted(values, p["w" + block][:, j], p["b" + block][j])
        normed = f"(({z}) - {float(p['rm' + block][j])!r}) / sqrt({float(p['rv' + block][j])!r} + {BN_EPS!r})"
        return f"greatest({normed} * {float(p['g' + block][j])!r} + {float(p['s' + block][j])!r}, 0)"

    return _columns(name, unit)


_SCORE_SQL = T.ITEM_PRICED_SQL + _SCALED_SQL + f""",
first_layer AS (SELECT *, {_scored_layer('1', [f'x{i}' for i in range(len(_FEATURES))], 'h')} FROM scaled),
second_layer AS (SELECT *, {_scored_layer('2', [f'h{i}' for i in _UNITS], 'k')} FROM first_layer)
SELECT sale_id, shoe_id, brand, sale_date, round({_weighted([f'k{i}' for i in _UNITS], _PARAMS['w3'][:, 0], _PARAMS['b3'][0])}, 6) AS predicted_premium,
       price_premium AS actual_premium
FROM second_layer"""


def _step_sql() -> str:
    """Gradients of all batches by the chain rule, weighted by rows, and the parameters after one Adam step."""
    p, w1, w2, w3 = _PARAMS, _PARAMS["w1"], _PARAMS["w2"], _PARAMS["w3"][:, 0]
    inputs = [f"x{i}" for i in range(len(_FEATURES))]

    def block(number: str, source: str, values: list[str], h: str) -> str:
        z = _columns("z", lambda j: _weighted(values, p["w" + number][:, j], p["b" + number][j]))
        moments = ", ".join(f"avg(z{j}) AS mean{j}, var_pop(z{j}) AS var{j}" for j in _UNITS)
        keep = ", ".join(f"mean{j} AS {h}mean{j}, var{j} AS {h}var{j}, (z{j} - mean{j}) / sqrt(var{j} + {BN_EPS!r}) AS {h}norm{j}" for j in _UNITS)
        pre = lambda j: f"{h}norm{j} * {float(p['g' + number][j])!r} + {float(p['s' + number][j])!r}"
        return f""",
{h}z AS (SELECT *, {z} FROM {source}),
{h}m AS (SELECT batch, {moments} FROM {h}z GROUP BY batch),
{h}n AS (SELECT {h}z.* EXCLUDE ({', '.join(f'z{j}' for j in _UNITS)}), {keep} FROM {h}z JOIN {h}m USING (batch)),
{h} AS (SELECT *, {_columns(h, lambda j: f'greatest({pre(j)}, 0)')}, {_columns(h + 'open', lambda j: f'CASE WHEN {pre(j)} > 0 THEN 1 ELSE 0 END')} FROM {h}n)"""

    def back(number: str, source: str, arriving, h: str) -> str:
        pre = _columns(f"{h}dpre", lambda j: f"({arriving(j)}) * {h}open{j}")
        gain = lambda j: f"{h}dpre{j} * {float(p['g' + number][j])!r}"
        means = ", ".join(f"avg({gain(j)}) AS a{j}, avg({gain(j)} * {h}norm{j}) AS c{j}" for j in _UNITS)
        dz = _columns(f"{h}dz", lambda j: f"({gain(j)} - a{j} - {h}norm{j} * c{j}) / sqrt({h}var{j} + {BN_EPS!r})")
        return f""",
{h}p AS (SELECT *, {pre} FROM {source}),
{h}a AS (SELECT batch, {means} FROM {h}p GROUP BY batch),
{h}d AS (SELECT {h}p.*, {dz} FROM {h}p JOIN {h}a USING (batch))"""

    # Per row; times the rows of its batch over all rows it is the row's share of the mean gradient.
    terms = {("w3", j): f"k{j} * dout" for j in _UNITS} | {("b3", 0): "dout"}
    for number, h, values in (("1", "h", inputs), ("2", "k", [f"h{i}" for i in _UNITS])):
        for j in _UNITS:
            terms |= {("g" + number, j): f"{h}dpre{j} * {h}norm{j}", ("s" + number, j): f"{h}dpre{j}", ("b" + number, j): f"{h}dz{j}"}
            terms |= {("w" + number, i * _HIDDEN + j): f"{v} * {h}dz{j}" for i, v in enumerate(values)}
            terms |= {("rm" + number, j): f"{h}mean{j} / n", ("rv" + number, j): f"{h}var{j} / greatest(n - 1, 1)"}
    named = ", ".join(f"sum(n * {term}) / count(*) AS {name}_{at}" for (name, at), term in terms.items())
    rows = []
    for (name, at), _ in terms.items():
        old, total = float(p[name].ravel()[at]), f"{name}_{at}"
        if name[0] == "r":
            rows.append(f"SELECT '{name}', {at}, NULL, 0.9 * {old!r} + 0.1 * {total} FROM totals")
        else:
            rows.append(f"SELECT '{name}', {at}, {total}, {old!r} - {_SPEC.learning_rate!r} * {total} / (abs({total}) + 1e-8) FROM totals")
    return (
        T.ITEM_PRICED_SQL + _SCALED_SQL + f""",
dealt AS (SELECT {', '.join(inputs)}, price_premium AS y, sale_id // {_BATCH_IDS} AS batch, count(*) OVER (PARTITION BY sale_id // {_BATCH_IDS}) AS n
          FROM scaled WHERE year(sale_date) < {SPLIT_YEAR} AND price_premium IS NOT NULL)"""
        + block("1", "dealt", inputs, "h") + block("2", "h", [f"h{i}" for i in _UNITS], "k")
        + f""",
errors AS (SELECT *, {_weighted([f'k{i}' for i in _UNITS], w3, p['b3'][0])} - y AS error FROM k),
starts AS (SELECT *, 2.0 / n * error AS dout FROM errors)"""
        + back("2", "starts", lambda j: f"dout * {float(w3[j])!r}", "k")
        + back("1", "kd", lambda i: " + ".join(f"kdz{j} * {float(w2[i, j])!r}" for j in _UNITS), "h")
        + f""",
totals AS (SELECT {named}, avg(error * error) AS loss FROM hd),
steps(name, place, gradient, value) AS ({' UNION ALL '.join(rows)} UNION ALL SELECT 'loss', 0, NULL, loss FROM totals)
SELECT name, place, round(gradient, 6) AS gradient, round(value, 6) AS value FROM steps"""
    )


def _rows(spark, folder):
    rows = item_priced(spark, folder).withColumn("size_gap", F.expr(_GAP))
    train, _ = temporal_split(rows, "sale_date", SPLIT_YEAR)
    return rows, train, fit_preprocessing(train, _FEATURES)


@query("mlp_score", _SCORE_SQL)
def mlp_score_query(spark, folder):
    """All rows scored by a network of fixed weights."""
    rows, _, preprocessing = _rows(spark, folder)
    model = NeuralModel(preprocessing, _SPEC, flatten(_PARAMS).tolist())
    return rounded(prediction_table(model.score(rows), PREDICTION_KEYS, TARGET), "predicted_premium")


@query("mlp_fit", _step_sql())
def mlp_fit_query(spark, folder):
    """A synchronous step over all training rows, in mini-batches by id: gradients, and parameters after it."""
    _, train, preprocessing = _rows(spark, folder)
    ready, count = training_rows(train, preprocessing, TARGET, F.col("sale_id"))
    chosen = F.floor(F.col("key") / _BATCH_IDS)
    size = len(_FEATURES)
    state, loss = run_epoch(ready, count, chosen, 1, 1 << 62, initial_state(flatten(_PARAMS)), 0, size, _SPEC)
    params, m = unflatten(state.params, size, _HIDDEN), unflatten(state.m, size, _HIDDEN)
    rows = [("loss", 0, None, loss)]
    for name, values in params.items():
        gradients = [None] * values.size if name[0] == "r" else (m[name].ravel() / (1 - ADAM_BETAS[0])).tolist()
        rows += [(name, at, g, v) for at, (g, v) in enumerate(zip(gradients, values.ravel().tolist()))]
    return rounded(spark.createDataFrame(rows, "name STRING, place INT, gradient DOUBLE, value DOUBLE"), "gradient", "value")
