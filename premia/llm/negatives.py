"""Hard negatives by angular triangle filtering.

Every vector stores its angles to a few reference directions. The angle between two vectors lies between the largest
difference and the smallest sum of their angles to a direction, so its cosine lies in an interval; times both norms, and widened
for rounding, that bounds their integer inner product. Blocks of vectors keep the range of each angle and are
visited by the anchors whose bounds reach the wanted scores; inside a block only vectors whose bounds do are scored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from premia.llm.arrays import release_memory
from premia.session import materialize

# Reference directions; vectors of a block and anchors that visit it together, on average.
DIRECTIONS, BLOCK_ROWS, ANCHORS = 8, 4096, 2048
# Blocks that one page of the directory lists.
PAGE = 512
# What rounding may do to an angle, and to a score relative to both norms. The integer score itself is exact.
ANGLE_SLACK, SCORE_SLACK = 1e-5, 1e-5

ANGLES = [f"t{i}" for i in range(DIRECTIONS)]
_BOX = [*(f"low_{t}" for t in ANGLES), *(f"high_{t}" for t in ANGLES), "low_norm", "high_norm"]


def directions(size: int) -> np.ndarray:
    """Fixed unit vectors of a size, the same everywhere."""
    out = np.random.default_rng(size).standard_normal((DIRECTIONS, size))
    return out / np.linalg.norm(out, axis=1, keepdims=True)


def angles_and_norms(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Angles of integer vectors to the directions, and their lengths. The zero vector has angles 0."""
    norms = np.sqrt(np.einsum("ij,ij->i", vectors, vectors, dtype=np.float64))
    cosines = vectors @ directions(vectors.shape[1]).T / np.maximum(norms, 1e-300)[:, None]
    return np.where(norms[:, None] > 0, np.arccos(np.clip(cosines, -1, 1)), 0.0), norms


def score_bounds(angles: np.ndarray, norm: np.ndarray, low: np.ndarray, high: np.ndarray, least: np.ndarray, most: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bounds of the scores of anchors (rows) with vectors (columns) whose angles lie in low..high, norms in least..most."""
    # Angles of single precision: the slack is wider than what that loses.
    angles, low, high = (np.ascontiguousarray(x.T, np.float32) for x in (angles, low, high))
    near = np.zeros((angles.shape[1], low.shape[1]), np.float32)
    far = np.full_like(near, np.pi)
    same = low is high or np.array_equal(low, high)
    for own, a, b in zip(angles[:, :, None], low[:, None, :], high[:, None, :]):
        np.maximum(near, np.abs(own - a) if same else np.maximum(a - own, own - b), out=near)
        total = own + b
        np.minimum(far, total, out=far)
        np.minimum(far, np.float32(2 * np.pi) - (total if same else own + a), out=far)
    top = np.cos(np.maximum(near - np.float32(2 * ANGLE_SLACK), 0))
    bottom = np.cos(np.minimum(far + np.float32(2 * ANGLE_SLACK), np.float32(np.pi)))
    most = norm[:, None] * most[None, :]
    slack = 1 + SCORE_SLACK * most
    if same:
        return bottom * most - slack, top * most + slack
    least = norm[:, None] * least[None, :]
    return np.minimum(bottom * least, bottom * most) - slack, np.maximum(top * least, top * most) + slack


def quantised(table: DataFrame, vec_id: str, vector: str, label: str) -> DataFrame:
    """(vec_id, label, size, vector, norm, angles) with components floor(256 x), of the rows that take part."""
    names = ["vec_id", "label", "size", "vector", "norm", *ANGLES]

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(2)
            sizes = np.diff(np.asarray(lists.offsets))
            values = np.asarray(lists.flatten(), np.float64)
            ends = np.cumsum(sizes)
            for size in np.unique(sizes).tolist():
                own = np.flatnonzero(sizes == size)
                whole = np.floor(256 * values[(ends[own] - size)[:, None] + np.arange(size)])
                if len(whole) and np.abs(whole).max(initial=0) >= 2**31:
                    raise ValueError("a component of a vector is out of range: 256 times its value must have 32 bits")
                ints = whole.astype(np.int32)
                theta, norm = angles_and_norms(whole)
                raw = ints.tobytes()
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(own)), batch.column(1).take(pa.array(own)), pa.array(np.full(len(own), size)),
                     pa.array([raw[4 * size * i : 4 * size * (i + 1)] for i in range(len(own))], pa.binary()), pa.array(norm),
                     *[pa.array(theta[:, j]) for j in range(DIRECTIONS)]],
                    names=names,
                )

    v = F.col(vector).cast("array<double>")
    sound = v.isNotNull() & (F.size(v) > 0) & ~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = table.where(F.col(vec_id).isNotNull() & F.col(label).isNotNull() & sound)
    kind = rows.schema[label].dataType.simpleString()
    return rows.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(label).alias("label"), v.alias("v")).mapInArrow(
        build, f"vec_id long, label {kind}, size long, vector binary, norm double, " + ", ".join(f"{t} double" for t in ANGLES)
    )


def in_blocks(vectors: DataFrame, rows: int) -> DataFrame:
    """Vectors with the number of their block: of one label and size, near one direction if there are many, about ``rows`` at most."""
    nearest = F.array_position(F.array(*ANGLES), F.array_min(F.array(*ANGLES)))
    celled = vectors.withColumn("cell", nearest)
    key = ["label", "size"]
    sizes = celled.groupBy(*key, "cell").agg(F.count("*").alias("own")).withColumn("all", F.sum("own").over(Window.partitionBy(*key)))
    few = F.col("all") <= DIRECTIONS * rows
    parts = F.ceil(F.when(few, F.col("all")).otherwise(F.col("own")) / rows)
    sizes = sizes.select(*key, "cell", F.when(few, 0).otherwise(F.col("cell")).alias("near"), parts.alias("parts"))
    placed = celled.join(sizes, [*key, "cell"]).drop("cell")
    part = F.pmod(F.xxhash64("vec_id", "vector"), F.col("parts"))
    return placed.withColumn("block", F.xxhash64(*key, "near", part)).drop("near", "parts")


def _ints(column: pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(column), np.int32).reshape(len(column), -1)


def _scores(vector: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Exact integer inner products of a vector with others."""
    most = int(np.abs(vector.astype(np.int64)).max(initial=0)) * int(np.abs(others.astype(np.int64)).max(initial=0)) * len(vector)
    if most < 2**53:
        return (others.astype(np.float64) @ vector.astype(np.float64)).astype(np.int64)
    if most >= 2**63:
        raise OverflowError("inner products do not fit 64 bits")
    return others.astype(np.int64) @ vector.astype(np.int64)


def _first(scores: np.ndarray, ids: np.ndarray, count: int) -> np.ndarray:
    """Positions of the first ``count`` by score, larger first, and id."""
    return np.lexsort((ids, -scores))[:count]


def _pages(anchors: DataFrame, blocks: DataFrame, wanted) -> DataFrame:
    """(akey, block) of the visits that ``wanted`` (a test of anchors against blocks) allows.

    Blocks are listed on pages of bounded size, anchors in chunks, and every chunk meets every page; vectors are not part of it.
    """
    count, of = anchors.count(), blocks.count()
    chunks, pages = max(1, -(-count // ANCHORS)), max(1, -(-of // PAGE))
    left = anchors.withColumn("chunk", F.pmod(F.xxhash64("akey"), F.lit(chunks))).withColumn("page", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(pages - 1).cast("long"))))
    right = blocks.withColumn("page", F.pmod(F.xxhash64("block"), F.lit(pages))).withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(chunks - 1).cast("long"))))

    def meet(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        if not len(a) or not len(b):
            return pd.DataFrame({"akey": [], "block": [], "chunk": []}).astype("int64")
        low, high = b[_BOX[:DIRECTIONS]].to_numpy(), b[_BOX[DIRECTIONS : 2 * DIRECTIONS]].to_numpy()
        bottom, top = score_bounds(a[ANGLES].to_numpy(), a["norm"].to_numpy(), low, high, b["low_norm"].to_numpy(), b["high_norm"].to_numpy())
        same = a["size"].to_numpy()[:, None] == b["size"].to_numpy()[None, :]
        row, column = np.nonzero(same & wanted(a, b, bottom, top))
        return pd.DataFrame({"akey": a["akey"].to_numpy()[row], "block": b["block"].to_numpy()[column], "chunk": a["chunk"].to_numpy()[row]})

    return left.groupBy("page", "chunk").cogroup(right.groupBy("page", "chunk")).applyInPandas(meet, "akey long, block long, chunk long")


def _visit(vectors: DataFrame, anchors: DataFrame, visits: DataFrame, score, schema: str) -> DataFrame:
    """Anchors meet the vectors of the blocks they visit, a chunk of anchors and a block at a time."""
    visits = materialize(visits, "visits")
    met = materialize(visits.select("block", "chunk").distinct(), "met")
    left = anchors.join(visits, "akey")
    right = vectors.drop("label", "size").join(met, "block")
    return left.groupBy("block", "chunk").cogroup(right.groupBy("block", "chunk")).applyInPandas(score, schema)


def _bounded(a: pd.DataFrame, x: pd.DataFrame) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Each anchor's bounds with all vectors of a block, some anchors at a time."""
    theta, norm = x[ANGLES].to_numpy(), x["norm"].to_numpy()
    step = max(1, (1 << 17) // max(len(x), 1))  # what fits a cache
    for at in range(0, len(a), step):
        part = a.iloc[at : at + step]
        bottom, top = score_bounds(part[ANGLES].to_numpy(), part["norm"].to_numpy(), theta, theta, norm, norm)
        for i in range(len(part)):
            yield at + i, bottom[i], top[i]


def nearest_positives(vectors: DataFrame, anchors: DataFrame, blocks: DataFrame, count: int) -> DataFrame:
    """(akey, place, positive_id, positive_score): the first ``count`` other vectors of each anchor's label and size."""

    def score(a: pd.DataFrame, x: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(a) and len(x):
            own, others, ids = _ints(a["vector"]), _ints(x["vector"]), x["vec_id"].to_numpy()
            for i, _, top in _bounded(a, x):
                able = np.flatnonzero((top >= a["floor"].iat[i]) & (ids != a["vec_id"].iat[i]))
                scores = _scores(own[i], others[able])
                best = _first(scores, ids[able], count)
                out.append(pd.DataFrame({"akey": a["akey"].iat[i], "id": ids[able][best], "score": scores[best]}))
        release_memory()
        return pd.concat(out) if out else pd.DataFrame({"akey": [], "id": [], "score": []}).astype("int64")

    ranked = Window.partitionBy("akey").orderBy(F.desc("score"), "id")
    home = anchors.withColumn("floor", F.lit(float("-inf")))
    at_home = home.select("akey", "block", F.pmod(F.xxhash64("akey"), F.lit(1 << 30)).alias("chunk"))
    at_home = at_home.withColumn("chunk", F.pmod("chunk", F.lit(max(1, -(-anchors.count() // ANCHORS)))))
    found = materialize(_visit(vectors, home.drop("block"), at_home, score, "akey long, id long, score long"), "home")
    # The score of the last of enough vectors at home is a floor for those elsewhere.
    floors = found.groupBy("akey").agg(F.when(F.count("*") >= count, F.min("score").cast("double")).otherwise(float("-inf")).alias("floor"))
    floored = materialize(anchors.join(floors, "akey", "left").withColumn("floor", F.coalesce("floor", F.lit(float("-inf")))), "floors")

    def wanted(a: pd.DataFrame, b: pd.DataFrame, bottom: np.ndarray, top: np.ndarray) -> np.ndarray:
        elsewhere = (a["block"].to_numpy()[:, None] != b["block"].to_numpy()[None, :]) & (a["label"].to_numpy()[:, None] == b["label"].to_numpy()[None, :])
        return elsewhere & (top >= a["floor"].to_numpy()[:, None])

    visits = _pages(floored.drop("vector"), blocks, wanted)
    more = _visit(vectors, floored.drop("block"), visits, score, "akey long, id long, score long")
    return found.union(more).withColumn("place", F.row_number().over(ranked)).where(F.col("place") <= count).select(
        "akey", "place", F.col("id").alias("positive_id"), F.col("score").alias("positive_score")
    )


def hard_negatives(table: DataFrame, anchor: Column, positives: int = 5, negatives: int = 3, low: tuple[int, int] = (50, 100), high: tuple[int, int] = (95, 100),
                   vec_id: str = "vec_id", vector: str = "embedding", label: str = "label", block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Hard negatives of every anchor and positive: (anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    Scores are integer inner products of the components floor(256 x). Anchors are the rows for which ``anchor`` (over the
    column ``vec_id``) holds. An anchor's positives are its first ``positives`` other rows of the same label; of the rows of other labels whose score
    is between ``low`` and ``high`` (fractions) of the positive's, the first ``negatives`` are returned. First is by larger
    score, then by smaller id. All rows are candidates; nothing is sampled or capped.

    Rows with a NULL id, label or vector, an empty vector, or a NULL or non-finite component take no part. Rows of another size
    than the anchor's are not compared with it, nor are rows with the anchor's id. Rows repeated as a whole are candidates
    each, and one anchor. Components of 2^31 / 256 and more raise. Columns of other names are not looked at. Empty table: no rows.
    """
    vectors = materialize(in_blocks(quantised(table, vec_id, vector, label), block_rows), "vectors")
    blocks = materialize(vectors.groupBy("block", "label", "size").agg(
        *[F.min(t).alias(f"low_{t}") for t in ANGLES], *[F.max(t).alias(f"high_{t}") for t in ANGLES], F.min("norm").alias("low_norm"), F.max("norm").alias("high_norm")
    ), "blocks")
    anchors = materialize(vectors.where(anchor).dropDuplicates(["vec_id", "label", "vector"]).withColumn("akey", F.xxhash64("vec_id", "label", "vector")), "anchors")
    found = materialize(nearest_positives(vectors, anchors, blocks, positives), "positives")
    # The range of scores that any positive of an anchor asks for; positives below 0 ask for none.
    ranges = found.where("positive_score >= 0").groupBy("akey").agg(
        F.sort_array(F.collect_list(F.struct("place", "positive_score"))).alias("places"),
        (F.min("positive_score") * (low[0] / low[1]) * (1 - 1e-12) - 1).alias("floor"), (F.max("positive_score") * (high[0] / high[1]) * (1 + 1e-12) + 1).alias("roof"),
    )
    asking = materialize(anchors.join(ranges, "akey").withColumn("wants", F.col("places.positive_score")).withColumn("places", F.col("places.place")), "asking")

    def wanted(a: pd.DataFrame, b: pd.DataFrame, bottom: np.ndarray, top: np.ndarray) -> np.ndarray:
        other = a["label"].to_numpy()[:, None] != b["label"].to_numpy()[None, :]
        return other & (top >= a["floor"].to_numpy()[:, None]) & (bottom <= a["roof"].to_numpy()[:, None])

    def score(a: pd.DataFrame, x: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(a) and len(x):
            own, others, ids = _ints(a["vector"]), _ints(x["vector"]), x["vec_id"].to_numpy()
            for i, bottom, top in _bounded(a, x):
                able = np.flatnonzero((top >= a["floor"].iat[i]) & (bottom <= a["roof"].iat[i]) & (ids != a["vec_id"].iat[i]))
                scores = _scores(own[i], others[able])
                wants = a["wants"].iat[i].tolist()
                windows = [(-(-low[0] * w // low[1]), high[0] * w // high[1]) for w in wants]
                asked = np.flatnonzero((scores >= min(w[0] for w in windows)) & (scores <= max(w[1] for w in windows)))
                names, scores = ids[able[asked]], scores[asked]
                order = _first(scores, names, len(scores))
                names, scores = names[order], scores[order]
                for place, (least, most) in zip(a["places"].iat[i].tolist(), windows):
                    best = np.arange(*np.searchsorted(-scores, (-most, -least + 1)))[:negatives]
                    out.append((np.full(len(best), a["akey"].iat[i]), np.full(len(best), place), names[best], scores[best]))
        release_memory()
        columns = [np.concatenate(c) for c in zip(*out)] if out else [np.empty(0, np.int64)] * 4
        return pd.DataFrame(dict(zip(("akey", "place", "id", "score"), columns)))

    visits = _pages(asking.drop("vector", "places", "wants", "block"), blocks, wanted)
    hits = _visit(vectors, asking.drop("block"), visits, score, "akey long, place int, id long, score long")
    order = Window.partitionBy("akey", "place").orderBy(F.desc("score"), "id")
    hits = hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= negatives)
    named = anchors.select("akey", F.col("vec_id").alias("anchor_id")).join(found, "akey")
    return named.join(hits, ["akey", "place"]).select(
        "anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
    )
