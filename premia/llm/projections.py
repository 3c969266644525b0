"""Near-duplicate vectors by counting collisions in one-dimensional projections."""

from __future__ import annotations

import math
from dataclasses import dataclass
from statistics import NormalDist

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from premia.llm.graph import components
from premia.session import materialize

# Share of links at the threshold that may be missed, by calculation.
MISSED = 1e-3
# Projections whose cells deal the vectors out, and projections whose collisions are counted.
CELL_PROJECTIONS, COUNTED_PROJECTIONS = 2, 16
# Half-width of a counted window, in standard deviations of a threshold pair's difference.
WINDOW_SIGMA = 2.0
# Vectors of a tile on either side.
TILE = 400


@dataclass(frozen=True)
class Plan:
    """Window sizes and the least count, calibrated for pairs at the threshold."""

    cosine: float
    cell: float
    window: float
    least: int
    seed: int = 11

    def directions(self, size: int) -> np.ndarray:
        """Random directions, the same in every task: one column each, cells first."""
        return np.random.default_rng([self.seed, size]).standard_normal((size, CELL_PROJECTIONS + COUNTED_PROJECTIONS))


def calibrated(cosine: float, missed: float = MISSED) -> Plan:
    """Windows that a pair of unit vectors at this cosine falls short of with probability ``missed`` at most.

    The difference of a random projection of such a pair is normal with deviation sqrt(2 - 2 cosine). Half of the
    allowance goes to the cells, which every pair must share, half to the count: the least number of collisions is the
    largest that a threshold pair reaches often enough, by the binomial distribution. Closer pairs collide more often.
    """
    sigma = math.sqrt(2 - 2 * cosine)
    normal = NormalDist()
    cell = normal.inv_cdf(1 - missed / (4 * CELL_PROJECTIONS)) * sigma
    p = 2 * normal.cdf(WINDOW_SIGMA) - 1
    n, least, below = COUNTED_PROJECTIONS, 0, 0.0
    while below + math.comb(n, least) * p**least * (1 - p) ** (n - least) <= missed / 2:
        below += math.comb(n, least) * p**least * (1 - p) ** (n - least)
        least += 1
    return Plan(cosine, cell, WINDOW_SIGMA * sigma, least)


def usable(vector) -> np.ndarray | None:
    """The vector as doubles of length one, or None if it has no direction."""
    if vector is None or any(x is None for x in vector):
        return None
    values = np.asarray(vector, dtype=np.float64)
    if not len(values) or not np.isfinite(values).all():
        return None
    values = values / (np.abs(values).max() or 1.0)
    norm = math.sqrt(float(values @ values))
    return values / norm if norm else None


def _unit(vectors: pd.Series) -> np.ndarray:
    values = np.stack([np.asarray(v, dtype=np.float64) for v in vectors])
    values /= np.abs(values).max(axis=1, keepdims=True)
    return values / np.sqrt((values * values).sum(axis=1, keepdims=True))


def cells(vectors: DataFrame, plan: Plan) -> DataFrame:
    """Usable vectors of (key, label, members, embedding) with their dimension and cell."""

    def place(batches):
        for frame in batches:
            frame = frame[np.array([usable(v) is not None for v in frame["embedding"]], bool)]
            for size, part in frame.groupby(frame["embedding"].map(len)):
                grid = np.floor(_unit(part["embedding"]) @ plan.directions(size)[:, :CELL_PROJECTIONS] / plan.cell).astype(np.int32)
                yield part.assign(size=np.int32(size), x=grid[:, 0], y=grid[:, 1])

    return vectors.mapInPandas(place, "key long, label int, members long, embedding array<double>, size int, x int, y int")


def _candidates(queries: np.ndarray, data: np.ndarray, plan: Plan):
    """Pairs (query, datum) that collide often enough, in blocks; both sides are rows of projections."""
    order = np.argsort(data[:, 0], kind="stable")
    line = data[order, 0]
    low = np.searchsorted(line, queries[:, 0] - plan.cell, side="left")
    high = np.searchsorted(line, queries[:, 0] + plan.cell, side="right")
    sizes = high - low
    start = 0
    while start < len(queries):
        end = max(int(np.searchsorted(np.cumsum(sizes[start:]), 400_000, side="right")) + start, start + 1)
        own = sizes[start:end]
        q = np.repeat(np.arange(start, end), own)
        d = order[np.arange(len(q)) - np.repeat(np.cumsum(own) - own, own) + np.repeat(low[start:end], own)]
        near = np.abs(queries[q, 1] - data[d, 1]) <= plan.cell
        q, d = q[near], d[near]
        count, left = np.zeros(len(q), np.int16), COUNTED_PROJECTIONS
        for j in range(CELL_PROJECTIONS, CELL_PROJECTIONS + COUNTED_PROJECTIONS):
            count += np.abs(queries[q, j] - data[d, j]) <= plan.window
            left -= 1
            if j % 4 == 1:  # drop pairs that can no longer reach the count
                able = count + left >= plan.least
                q, d, count = q[able], d[able], count[able]
        yield q, d
        start = end


def _roots(count: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The least member of each component of the links a-b."""
    root = np.arange(count)
    while True:
        new = root.copy()
        low = np.minimum(root[a], root[b])
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        np.minimum.at(new, root[a], low)
        np.minimum.at(new, root[b], low)
        new = new[new]
        if (new == root).all():
            return root
        root = new


def _tile(frame: pd.DataFrame, plan: Plan) -> pd.DataFrame:
    """Verified links of one tile, per vector: (key, links, root), the root being the tile's least key of its component."""
    frame = frame.reset_index(drop=True)
    data, queries = np.flatnonzero(frame["role"] == 0), np.flatnonzero(frame["role"] > 0)
    if not len(data) or not len(queries):
        return pd.DataFrame({"key": np.empty(0, np.int64), "links": np.empty(0, np.int64), "root": np.empty(0, np.int64)})
    unit = _unit(frame["embedding"])
    spots = unit @ plan.directions(unit.shape[1])
    key, members, home = frame["key"].to_numpy(), frame["members"].to_numpy(), frame["role"].to_numpy() == 1
    lefts, rights = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    for q, d in _candidates(spots[queries], spots[data], plan):
        q, d = queries[q], data[d]
        once = ~home[q] | (key[q] < key[d])  # pairs of the same cell come from both sides
        q, d = q[once], d[once]
        for i in range(0, len(q), 50_000):
            a, b = q[i : i + 50_000], d[i : i + 50_000]
            same = (unit[a] * unit[b]).sum(axis=1) >= plan.cosine
            lefts.append(a[same])
            rights.append(b[same])
    a, b = np.concatenate(lefts), np.concatenate(rights)
    # One vector may stand on both sides: count and connect by key.
    keys, at = np.unique(key, return_inverse=True)
    weight = np.zeros(len(keys), np.int64)
    weight[at] = members
    a, b = at[a], at[b]
    links = np.bincount(a, weights=weight[b], minlength=len(keys)) + np.bincount(b, weights=weight[a], minlength=len(keys))
    touched = np.flatnonzero(links > 0)
    return pd.DataFrame({"key": keys[touched], "links": links[touched].astype(np.int64), "root": keys[_roots(len(keys), a, b)][touched]})


def near_vectors(embeddings: DataFrame, cosine: float = 0.98, missed: float = MISSED, tile: int = TILE,
                 vec_id: str = "vec_id", label: str = "label", embedding: str = "embedding") -> DataFrame:
    """Links and components of near-duplicate vectors: (vec_id, n_links, component_id, kept), a row per row.

    Two vectors of equal label and dimension are linked if their cosine in double precision is at least
    ``cosine``. n_links counts the other vectors linked directly, component_id is the smallest id reachable.

    Unit vectors are projected to random lines. Two of the lines cut the label into cells that a pair at the threshold shares or
    neighbours; cells meet their neighbours in tiles of bounded size, however many vectors share a cell. In a tile the
    vectors are sorted along the first line, each query's window is read off, and collisions in windows of the
    other lines are counted; pairs that reach the calibrated count are verified. Links at the threshold are found
    with probability 1 - ``missed`` at least, closer ones almost surely; none is reported below it. A tile returns a
    row per vector, not its pairs. Equal vectors of one label are one class with a weight, so copies never form pairs.

    Vectors that are NULL, empty, zero, or hold NULL or non-finite components link with nothing; so do NULL labels and NULL ids
    (their component is the id itself). Rows that repeat an id with other
    vectors are one node: they share links and component. Other columns are not read. No rows: no rows.
    """
    plan = calibrated(cosine, missed)
    rows = materialize(
        embeddings.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(label).cast("int").alias("label"), F.col(embedding).cast("array<double>").alias("embedding")),
        "vectors",
    )
    valid = rows.where("vec_id is not null and label is not null and embedding is not null")
    same = [F.xxhash64("label", "embedding").alias("h1"), F.hash("embedding", "label").alias("h2")]
    classes = valid.select("*", *same).groupBy("h1", "h2").agg(
        F.min("vec_id").alias("key"), F.count("*").alias("members"), F.first("label").alias("label"), F.first("embedding").alias("embedding")
    )
    placed = materialize(
        classes.select("key", "label", "members", "embedding").transform(lambda c: cells(c, plan)).withColumn("spot", F.xxhash64("key", "embedding")),
        "cells",
    )
    counts = placed.groupBy("label", "size", "x", "y").agg(F.count("*").alias("n"))
    steps = F.array(*[F.struct(F.lit(dx).alias("dx"), F.lit(dy).alias("dy"), F.lit(1 if (dx, dy) == (0, 0) else 2).alias("role"))
                      for dx, dy in ((0, 0), (1, -1), (1, 0), (1, 1), (0, 1))])
    # How many data blocks a cell has, and how many blocks of queries come to it.
    asking = (
        counts.select("label", "size", "n", "x", "y", F.explode(steps).alias("s"))
        .groupBy("label", "size", (F.col("x") + F.col("s.dx")).alias("cx"), (F.col("y") + F.col("s.dy")).alias("cy")).agg(F.sum("n").alias("asking"))
    )
    shape = materialize(
        counts.select("label", "size", F.col("x").alias("cx"), F.col("y").alias("cy"), F.ceil(F.col("n") / tile).cast("int").alias("blocks"))
        .join(asking, ["label", "size", "cx", "cy"])
        .select("label", "size", "cx", "cy", "blocks", F.ceil(F.col("asking") / (2 * tile)).cast("int").alias("chunks")),
        "tiles",
    )
    payload = ["key", "members", "embedding", "spot"]
    data = placed.withColumnsRenamed({"x": "cx", "y": "cy"}).join(shape, ["label", "size", "cx", "cy"]).select(
        "label", "size", "cx", "cy", *payload, F.lit(0).alias("role"),
        F.pmod("spot", "blocks").cast("int").alias("block"), F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk"),
    )
    asked = placed.select("label", "size", "x", "y", *payload, F.explode(steps).alias("s")).select(
        "label", "size", (F.col("x") + F.col("s.dx")).alias("cx"), (F.col("y") + F.col("s.dy")).alias("cy"), *payload, "s.role"
    )
    queries = asked.join(shape, ["label", "size", "cx", "cy"]).select(
        "label", "size", "cx", "cy", *payload, "role",
        F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), F.pmod("spot", "chunks").cast("int").alias("chunk"),
    )
    found = data.unionByName(queries).groupBy("label", "size", "cx", "cy", "block", "chunk").applyInPandas(
        lambda frame: _tile(frame[["key", "members", "embedding", "role"]], plan), "key long, links long, root long"
    )
    found = materialize(found, "links")
    roots = components(found.select("key", "root"))
    # Ids may be repeated: links are counted per class of equal vectors, components per id.
    links = found.groupBy("key").agg(F.sum("links").alias("links"))
    named = classes.select("h1", "h2", "key", "members").join(links, "key", "left")
    sized = rows.select("vec_id", "label", *same, F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull() & _has_direction(F.col("embedding")))
    sized = sized.toDF("vec_id", "label", "h1", "h2", "usable")
    joined = sized.join(named, ["h1", "h2"], "left").join(roots, F.col("key") == F.col("node"), "left")
    able = F.coalesce("usable", F.lit(False))
    component = F.when(able, F.coalesce("root", "key")).otherwise(F.col("vec_id"))
    return joined.select(
        "vec_id",
        F.when(able, F.coalesce("links", F.lit(0)) + F.col("members") - 1).otherwise(0).cast("long").alias("n_links"),
        component.alias("component_id"), (F.col("vec_id") == component).alias("kept"),
    )


def _has_direction(vector):
    good = F.forall(vector, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    return good & F.exists(vector, lambda x: x != 0)
