"""Mergeable moments and the linear models they give, against plain least squares."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from premia.operators.models import fit_linear, fit_linear_by, linear_of
from premia.operators.moments import Moments, moments
from premia.operators.prep import fit_preprocessing

NAMES = ["a", "b", "c"]


def table(rows=600, seed=1):
    """Far from zero, of very different spreads, with gaps in an input and in the target."""
    rng = np.random.default_rng(seed)
    v = rng.normal(size=(rows, 4)) * [1, 5, 1e-3, 1] + [1e6, -3, 7, 2]
    v[:, 3] = 2 * v[:, 0] - v[:, 1] + rng.normal(size=rows)
    v[rng.random(rows) < 0.2, 1] = np.nan
    v[rng.random(rows) < 0.1, 3] = np.nan
    return v


def expected(v):
    x, y = v[:, :3], v[:, 3]
    mean = np.nanmean(x, axis=0)
    x = np.where(np.isnan(x), mean, x)
    std, known = x.std(axis=0), ~np.isnan(y)
    z = (x - mean) / std
    return mean, std, np.linalg.lstsq(np.c_[z, np.ones(len(z))][known], y[known], rcond=None)[0]


def frame(spark, v):
    rows = [(int(i % 3), *(None if np.isnan(x) and i % 2 else float(x) for x in row)) for i, row in enumerate(v)]
    return spark.createDataFrame(rows, "g INT, a DOUBLE, b DOUBLE, c DOUBLE, y DOUBLE")


def check(model, v):
    mean, std, fitted = expected(v)
    np.testing.assert_allclose(model.preprocessing.mean, mean, rtol=1e-12)
    np.testing.assert_allclose(model.preprocessing.std, std, rtol=1e-7)
    np.testing.assert_allclose([*model.coefficients, model.intercept], fitted, rtol=1e-6)


def test_states_merge_in_any_cut():
    v = table()
    whole, merged = Moments.of(v), Moments.of(v[:0])
    for at in range(0, len(v), 7):
        merged = merged.merged(Moments.unflat(Moments.of(v[at : at + 7]).flat(), 4))
    assert merged.rows == whole.rows == len(v)
    for state in (whole, merged):
        check(linear_of(state, NAMES), v)


def test_one_pass_over_many_tasks(spark):
    v = table()
    rows = frame(spark, v).repartition(5)
    model = fit_linear(rows, NAMES, "y")
    check(model, v)
    two_pass = fit_preprocessing(rows, NAMES)
    np.testing.assert_allclose(model.preprocessing.std, two_pass.std, rtol=1e-7)
    # A state can go on with rows that come later.
    later = table(seed=9)
    check(linear_of(moments(rows, NAMES, "y").merged(moments(frame(spark, later), NAMES, "y")), NAMES), np.concatenate([v, later]))


def test_a_fit_is_one_job(spark):
    rows = frame(spark, table())
    tracker, context = spark.sparkContext.statusTracker(), spark.sparkContext
    context.setJobGroup("fit", "linear fit")
    fit_linear(rows, NAMES, "y")
    context.setJobGroup("other", "other")
    assert 1 <= len(tracker.getJobIdsForGroup("fit")) <= 2  # the pass and, with adaptive plans, the merge


def test_models_per_group(spark):
    v = table()
    rows = {(r["g"], r["term"]): (r["n"], r["weight"]) for r in fit_linear_by(frame(spark, v).repartition(4), NAMES, "y", ["g"]).collect()}
    for g in range(3):
        own = v[g::3]
        mean, std, fitted = expected(own)
        slopes = fitted[:3] / std
        got = [rows[g, t][1] for t in (*NAMES, "intercept")]
        np.testing.assert_allclose(got, [*slopes, fitted[3] - slopes @ mean], rtol=1e-5)
        assert rows[g, "a"][0] == (~np.isnan(own[:, 3])).sum()


def test_constant_missing_and_dependent_inputs(spark):
    rows = spark.range(50).select(F.col("id").cast("double").alias("a"), F.lit(7.0).alias("b"), F.lit(None).cast("double").alias("c"), (F.col("id") * 3 + 1.0).alias("y"), (F.col("id") * 2.0).alias("d"))
    model = fit_linear(rows, NAMES, "y")
    assert model.preprocessing.std[1:] == [1.0, 1.0] and model.coefficients[1:] == [0.0, 0.0]
    assert model.score(rows).agg(F.max(F.abs(F.col("predicted_premium") - F.col("y")))).first()[0] < 1e-9
    twice = fit_linear(rows, ["a", "d"], "y")
    assert twice.coefficients == pytest.approx([twice.coefficients[0]] * 2)
    assert twice.score(rows).agg(F.max(F.abs(F.col("predicted_premium") - F.col("y")))).first()[0] < 1e-9


def test_no_target(spark):
    rows = spark.createDataFrame([(1.0, None)], "a DOUBLE, y DOUBLE")
    with pytest.raises(ValueError, match="no rows with a target"):
        fit_linear(rows, ["a"], "y")
    assert fit_linear_by(rows.withColumn("g", F.lit(1)), ["a"], "y", ["g"]).count() == 0
