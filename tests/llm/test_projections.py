"""Near-duplicate vectors against brute force."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from premia.llm.projections import calibrated, near_vectors


def brute(rows, cosine=0.98):
    """rows: (vec_id, embedding, label)."""
    def good(v):
        return v is not None and len(v) and all(x is not None and math.isfinite(x) for x in v) and any(v)

    n = len(rows)
    usable = [i is not None and l is not None and bool(good(v)) for i, v, l in rows]
    links = [[] for _ in range(n)]
    unit = [np.array(v, float) / np.linalg.norm(np.array(v, float)) if u else None for (_, v, _), u in zip(rows, usable)]
    for i in range(n):
        for j in range(i):
            if usable[i] and usable[j] and rows[i][2] == rows[j][2] and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= cosine:
                links[i].append(j)
                links[j].append(i)
    out = []
    for i in range(n):
        seen, todo = {i}, [i]
        while todo:
            for j in links[todo.pop()]:
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        root = min((rows[j][0] for j in seen), default=None) if usable[i] else rows[i][0]
        out.append((rows[i][0], len(links[i]), root, None if rows[i][0] is None else rows[i][0] == root))
    return sorted(out, key=str)


def frame_of(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")


def cases(seed=0, clusters=12, dim=64):
    rng = np.random.default_rng(seed)
    rows = []
    for c in range(clusters):
        base = rng.standard_normal(dim)
        base /= np.linalg.norm(base)
        for _ in range(int(rng.integers(1, 25))):
            v = base + rng.standard_normal(dim) * rng.choice([0.002, 0.01, 0.015]) 
            rows.append((len(rows), [float(np.float32(x)) for x in v * rng.uniform(0.1, 9)], c % 3))
    return rows


@pytest.mark.parametrize("tile", [400, 7])
def test_equals_brute_force(llm_spark, tile):
    rows = cases()
    got = sorted(map(tuple, near_vectors(frame_of(llm_spark, rows), tile=tile).collect()), key=str)
    assert got == brute(rows)


def test_small_table(llm_spark, small):
    table = llm_spark.read.parquet(f"{small}/embeddings.parquet")
    rows = [(r.vec_id, r.embedding, r.label) for r in table.collect()]
    assert sorted(map(tuple, near_vectors(table).collect()), key=str) == brute(rows)


def test_edges(llm_spark):
    v = [1.0, 0.5, 0.25]
    rows = [(1, v, 0), (2, v, 0), (3, [2.0, 1.0, 0.5], 0), (4, v, 1), (5, v, None), (None, v, 0), (6, None, 0), (7, [], 0), (8, [0.0, 0.0, 0.0], 0)]
    rows += [(9, [float("nan"), 1.0, 1.0], 0), (10, [float("inf"), 1.0, 1.0], 0), (11, [1.0, None, 1.0], 0), (12, [1.0, 0.5], 0), (13, [-1.0, -0.5, -0.25], 0), (14, [1e-30, 5e-31, 2.5e-31], 0)]
    table = frame_of(llm_spark, rows).withColumns({c: F.lit(1) for c in ("key", "n", "x", "root", "links", "kept", "component_id")})
    assert sorted(map(tuple, near_vectors(table).collect()), key=str) == brute(rows)
    assert near_vectors(table.limit(0)).count() == 0


def test_repeated_rows(llm_spark):
    rows = [(1, [1.0, 0.0], 0), (1, [1.0, 0.0], 0), (2, [1.0, 0.001], 0)]
    assert sorted(map(tuple, near_vectors(frame_of(llm_spark, rows)).collect())) == [(1, 2, 1, True), (1, 2, 1, True), (2, 2, 1, False)]


def test_calibration_holds_on_threshold_pairs():
    plan, rng = calibrated(0.98), np.random.default_rng(4)
    a = rng.standard_normal((20_000, 64))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    b = rng.standard_normal(a.shape)
    b -= (a * b).sum(axis=1, keepdims=True) * a
    b /= np.linalg.norm(b, axis=1, keepdims=True)
    b = 0.98 * a + math.sqrt(1 - 0.98**2) * b
    gap = np.abs((a - b) @ plan.directions(64))
    found = (gap[:, :2] <= plan.cell).all(axis=1) & ((gap[:, 2:] <= plan.window).sum(axis=1) >= plan.least)
    assert found.mean() > 0.995
