"""Hard negatives against brute force."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from premia.llm import negatives

COLUMNS = "vec_id long, embedding array<float>, label int"


def brute(rows, positives=5, count=3):
    sound = [(i, [math.floor(256 * float(np.float32(x))) for x in v], label) for i, v, label in rows
             if i is not None and label is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for a in {(i, tuple(v), label) for i, v, label in sound if i % 50 == 0}:
        scored = [(-sum(p * q for p, q in zip(a[1], v)), i, label == a[2]) for i, v, label in sound if i != a[0] and len(v) == len(a[1])]
        scored.sort()
        for p, i, _ in [s for s in scored if s[2]][:positives]:
            inside = [s for s in scored if not s[2] and 50 * -p <= 100 * -s[0] <= 95 * -p][:count]
            out += [(a[0], i, rank, s[1], -p, -s[0]) for rank, s in enumerate(inside, 1)]
    return sorted(out)


def ours(frame, **options):
    return sorted(map(tuple, negatives.hard_negatives(frame, F.col("vec_id") % 50 == 0, **options).collect()))


def vectors():
    rng = random.Random(4)
    centres = [[rng.gauss(0, 1) for _ in range(6)] for _ in range(5)]
    rows = []
    for i in range(320):
        centre = rng.choice(centres)
        rows.append((i, [round(c + rng.gauss(0, 0.3), 1) for c in centre], rng.choice([0, 0, 0, 1, 2])))
    rows += [(400, [0.0] * 6, 0), (401, [0.0] * 6, 1), (350, [0.0] * 6, 1), (402, [1.0, 2.0], 0), (450, [1.0, 2.0], 0), (403, [0.7, 1.4], 1)]
    rows += [(404, None, 0), (405, [1.0] * 5 + [None], 0), (406, [1.0] * 5 + [float("nan")], 1), (407, [1.0] * 5 + [float("inf")], 1), (408, [1.0] * 6, None), (None, [1.0] * 6, 0), (409, [], 0)]
    return rows + rows[:60] + [(100, [0.5] * 6, 2)]


@pytest.mark.parametrize("block_rows", [4096, 25])
def test_equals_brute_force(llm_spark, monkeypatch, block_rows):
    monkeypatch.setattr(negatives, "ANCHORS", 4)
    monkeypatch.setattr(negatives, "PAGE", 3)
    rows = vectors()
    frame = llm_spark.createDataFrame(rows, COLUMNS).withColumns({c: F.lit("own") for c in ("block", "akey", "t0", "norm", "size", "chunk", "cell")})
    assert ours(frame, block_rows=block_rows) == brute(rows)


def test_empty_table(llm_spark):
    assert ours(llm_spark.createDataFrame([], COLUMNS)) == []


def test_large_components(llm_spark):
    rows = [(50, [3e6, 2e6], 0), (1, [3e6, 1e6], 0), (2, [2e6, 1e6], 1), (3, [-3e6, 1.0], 1)]
    assert ours(llm_spark.createDataFrame(rows, COLUMNS)) == brute(rows)
    with pytest.raises(Exception, match="out of range"):
        ours(llm_spark.createDataFrame([(1, [1e30], 0)], COLUMNS))


def test_bounds_hold_and_cut():
    rng = np.random.default_rng(2)
    whole = np.floor(256 * np.concatenate([rng.standard_normal((60, 4)), rng.standard_normal((3, 4)).repeat(30, 0) + 0.01 * rng.standard_normal((90, 4)), np.zeros((1, 4))]))
    theta, norm = negatives.angles_and_norms(whole)
    bottom, top = negatives.score_bounds(theta, norm, theta, theta, norm, norm)
    scores = whole @ whole.T
    assert (bottom <= scores).all() and (scores <= top).all()
    # Bounds tell most pairs of different directions apart from the closest ones.
    assert (top < 0.9 * norm[:, None] * norm[None, :]).mean() > 0.5
