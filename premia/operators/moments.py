"""Mergeable sufficient statistics of a linear model: counts, sums and cross products from one pass over the rows.

Every task adds up its own rows around a centre of its own, so nothing is lost to cancellation; two states are put
together by moving one to the centre of the other. A state has a fixed size, set by the number of columns, and is all
a model needs: means for the gaps, spreads, and the normal equations of the filled and standardised inputs.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from premia.functions.prices import nan_to_null
from premia.operators.prep import Preprocessing

# Tasks that put the states of all others together before the driver adds up theirs.
MERGING_TASKS = 32
# Groups whose states a task holds at a time.
MOST_GROUPS = 2000


@dataclass
class Moments:
    """Sums around ``centre`` over inputs and target (the last column).

    ``rows``, ``given``, ``first`` and ``second`` (rows, and present values with their sums of first and second powers, per column)
    are over all rows; ``pairs``, ``sums`` and ``products`` over rows with a target: for columns i and j the rows that have
    both, the sum of i over these, and the sum of the products.
    """

    rows: float
    centre: np.ndarray
    given: np.ndarray
    first: np.ndarray
    second: np.ndarray
    pairs: np.ndarray
    sums: np.ndarray
    products: np.ndarray

    @staticmethod
    def of(values: np.ndarray) -> Moments:
        """The state of some rows; NaN is missing."""
        present = np.isfinite(values)
        given = present.sum(axis=0).astype(float)
        centre = np.where(present, values, 0.0).sum(axis=0) / np.maximum(given, 1.0)
        shifted = np.where(present, values - centre, 0.0)
        labelled = present[:, -1]
        x, w = shifted[labelled], present[labelled].astype(float)
        return Moments(
            float(len(values)), centre, given, shifted.sum(axis=0), (shifted**2).sum(axis=0), w.T @ w, x.T @ w, x.T @ x
        )

    def around(self, centre: np.ndarray) -> Moments:
        """The same sums around another centre."""
        by = self.centre - centre
        second = self.second + 2 * by * self.first + self.given * by**2
        sums = self.sums + self.pairs * by[:, None]
        products = self.products + by[None, :] * self.sums + by[:, None] * self.sums.T + self.pairs * np.outer(by, by)
        return Moments(self.rows, centre, self.given, self.first + self.given * by, second, self.pairs, sums, products)

    def merged(self, other: Moments) -> Moments:
        """The state of both sets of rows, around the mean of each column."""
        given = np.maximum(self.given + other.given, 1.0)
        centre = (self.given * self.centre + self.first + other.given * other.centre + other.first) / given
        a, b = self.around(centre), other.around(centre)
        return Moments(
            a.rows + b.rows, centre, a.given + b.given, a.first + b.first, a.second + b.second, a.pairs + b.pairs, a.sums + b.sums, a.products + b.products
        )

    def flat(self) -> np.ndarray:
        return np.concatenate([[self.rows], *(np.ravel(part) for part in (self.centre, self.given, self.first, self.second, self.pairs, self.sums, self.products))])

    @staticmethod
    def unflat(values: np.ndarray, columns: int) -> Moments:
        bounds = np.cumsum([1, *[columns] * 4, *[columns * columns] * 3])
        rows, *parts = np.split(np.asarray(values, float), bounds[:-1])
        return Moments(float(rows[0]), *parts[:4], *(p.reshape(columns, columns) for p in parts[4:]))

    def preprocessing(self, features: Sequence[str]) -> Preprocessing:
        """Fill-in values, means and spreads: gaps take the mean, so they leave it as it is and add nothing to the spread."""
        size = len(features)
        n = np.maximum(self.given[:size], 1.0)
        mean = np.where(self.given[:size] > 0, self.centre[:size] + self.first[:size] / n, 0.0)
        variance = np.maximum(self.second[:size] / n - (self.first[:size] / n) ** 2, 0.0) * self.given[:size] / max(self.rows, 1.0)
        # What is left of a constant column's variance is rounding.
        spread = np.where(variance > (1e-14 * np.abs(mean)) ** 2, np.sqrt(variance), 0.0)
        std = np.where(spread > 0, spread, 1.0)
        return Preprocessing(list(features), mean.tolist(), mean.tolist(), std.tolist())

    def least_squares(self, preprocessing: Preprocessing) -> tuple[np.ndarray, float]:
        """Weights and intercept over filled, standardised inputs, by Cholesky; of dependent inputs the shortest weights."""
        size = len(preprocessing.features)
        labelled = self.pairs[-1, -1]
        if not labelled:
            raise ValueError("there are no rows with a target to fit on")
        target = self.centre[-1] + self.sums[-1, -1] / labelled
        at = self.around(np.append(preprocessing.mean, target))
        std = np.asarray(preprocessing.std)
        mean = np.diag(at.sums)[:size] / std / labelled
        matrix = at.products[:size, :size] / np.outer(std, std) - labelled * np.outer(mean, mean)
        right = at.products[:size, -1] / std
        scale = np.sqrt(np.maximum(np.diag(matrix), 0.0))
        able = scale > 1e-9 * np.sqrt(labelled)
        weights = np.zeros(size)
        if able.any():
            unit = matrix[np.ix_(able, able)] / np.outer(scale[able], scale[able])
            scaled = right[able] / scale[able]
            try:
                np.linalg.cholesky(unit - 1e-10 * np.eye(len(unit)))  # fails if inputs depend on each other
                lower = np.linalg.cholesky(unit)
                solved = np.linalg.solve(lower.T, np.linalg.solve(lower, scaled))
            except np.linalg.LinAlgError:
                solved = np.linalg.lstsq(unit, scaled, rcond=1e-10)[0]
            weights[able] = solved / scale[able]
        return weights, float(target - weights @ mean)


def moments(rows: DataFrame, features: Sequence[str], target: str) -> Moments:
    """The state of all rows in one pass: a state per task, put together by a few tasks, then by the driver."""
    size = len(features) + 1
    states = _states(rows, features, target, []).repartition(MERGING_TASKS).mapInPandas(_merge_all(size), "state array<double>")
    total = _empty(size)
    for row in states.collect():
        total = total.merged(Moments.unflat(row["state"], size))
    return total


def moments_by(rows: DataFrame, features: Sequence[str], target: str, keys: Sequence[str]) -> DataFrame:
    """(keys, state) of every group: states per task and group are put together by group, rows are not shuffled."""
    size = len(features) + 1
    schema = ", ".join(f"`{k}` {rows.schema[k].dataType.simpleString()}" for k in keys)

    def merge(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        state = next(_merge_all(size)(iter([frame])))["state"].iat[0]
        return pd.DataFrame({**{k: [v] for k, v in zip(keys, key)}, "state": [state]})

    return _states(rows, features, target, keys).groupBy(*keys).applyInPandas(merge, f"{schema}, state array<double>")


def _empty(size: int) -> Moments:
    return Moments.of(np.empty((0, size)))


def _merge_all(size: int):
    def merge(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = _empty(size)
        for frame in frames:
            for state in frame["state"]:
                total = total.merged(Moments.unflat(state, size))
        yield pd.DataFrame({"state": [total.flat()]})

    return merge


def _states(rows: DataFrame, features: Sequence[str], target: str, keys: Sequence[str]) -> DataFrame:
    """(keys, state): a state per task, or per task and group."""
    columns = [nan_to_null(F.col(c).cast("double")).alias(f"v{i}") for i, c in enumerate([*features, target])]
    chosen, count, names = rows.select(*keys, *columns), len(keys), [*keys, "state"]
    values_at = range(count, count + len(columns))
    schema = ", ".join([*(f"`{k}` {rows.schema[k].dataType.simpleString()}" for k in keys), "state array<double>"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, Moments] = {}
        for batch in batches:
            values = np.column_stack([batch.column(i).to_numpy(zero_copy_only=False).astype(float) for i in values_at])
            for key, own in _groups(batch, count):
                state = Moments.of(values if own is None else values[own])
                held[key] = held[key].merged(state) if key in held else state
            if len(held) > MOST_GROUPS:
                yield _batch(held, batch)
                held = {}
        if held:
            yield _batch(held, batch)

    def _batch(held: dict[tuple, Moments], like: pa.RecordBatch) -> pa.RecordBatch:
        parts = [pa.array([key[i] for key in held], like.schema.field(i).type) for i in range(count)]
        states = pa.array([m.flat() for m in held.values()], pa.list_(pa.float64()))
        return pa.RecordBatch.from_arrays([*parts, states], names=names)

    return chosen.mapInArrow(add, schema)


def _groups(batch: pa.RecordBatch, keys: int) -> Iterator[tuple[tuple, np.ndarray | None]]:
    """The rows of each group in a batch; without keys all rows are one group."""
    if not batch.num_rows:
        return
    if not keys:
        yield (), None
        return
    codes = pd.MultiIndex.from_arrays([pc.dictionary_encode(batch.column(i), "encode").indices.to_numpy() for i in range(keys)])
    number, firsts = pd.factorize(codes)
    order = np.argsort(number, kind="stable")
    bounds = np.searchsorted(number[order], np.arange(len(firsts) + 1))
    for g in range(len(firsts)):
        own = order[bounds[g] : bounds[g + 1]]
        yield tuple(batch.column(i)[int(own[0])].as_py() for i in range(keys)), own
