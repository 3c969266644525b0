"""Exact quantiles of columns of any size, by counting.

A mergeable sketch, taken in the pass that finds the extremes, tells about where a wanted rank lies. A round cuts such a
bracket into slices, counts the values of each slice, and of the gaps between brackets, with their extremes, and goes on inside
the part that the rank falls into, until it holds one value only. So the sketch saves rounds, but the result does not rest on it. A round
reads the rows once for all columns, a value belongs to one part; what is shuffled and ordered are parts, never rows. Limits
and counts are all that comes to the driver.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import add

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from premia.functions.prices import nan_to_null

# Slices of all brackets of a round together, and the fewest of one bracket.
ROUND_SLICES, LEAST_SLICES = 32_768, 64
# A bracket of one sign whose ends are further apart than this factor is cut by magnitude.
WIDE = 4096.0
# The sketch errs by one rank in so many; a bracket reaches this share of the ranks to either side of the wanted one.
SKETCH_ACCURACY, REACH = 10_000, 0.001


def evenly_spaced(bins: int) -> list[float]:
    """The probabilities of ``bins`` equal-frequency bins, as numpy's linspace gives them."""
    return [float(q) for q in np.linspace(0, 1, bins + 1)]


@dataclass(frozen=True)
class _Bracket:
    """Values of ``column`` from ``low`` to ``high``."""

    column: str
    low: float
    high: float

    def slice_of(self, slices: int) -> Column:
        """The number of a value's slice: it never falls with the value, and differs at the two ends."""
        x = F.col(self.column)
        low, high = self.low, self.high
        if low < 0 < high or (low == 0 or high == 0) and max(-low, high) > WIDE:
            # Zero apart, the signs apart: within one sign magnitudes can be compared.
            return F.signum(x).cast("int") + 1
        near, far = min(abs(low), abs(high)), max(abs(low), abs(high))
        if near > 0 and far / WIDE > near:
            span = math.log(far) - math.log(near)
            share = (F.log(F.abs(x)) - math.log(near)) / span
            share = share if low > 0 else 1 - share
        else:
            # Halves, so that the width of the widest bracket is finite.
            share = (x / 2 - low / 2) / (high / 2 - low / 2)
        inner = F.floor(F.least(F.greatest(share, F.lit(0.0)), F.lit(1.0)) * (slices - 2)).cast("int")
        return F.when(x == F.lit(low), 0).when(x == F.lit(high), slices).otherwise(inner + 1)


def approximate_quantiles(
    rows: DataFrame, columns: Sequence[str], probabilities: Sequence[float], accuracy: int = SKETCH_ACCURACY
) -> dict[str, list[float]]:
    """Values whose rank is off by at most one in ``accuracy`` of the column's values, from one pass. Missing values do not count."""
    values = [nan_to_null(F.col(c).cast("double")) for c in columns]
    wanted = F.array(*(F.lit(float(q)) for q in probabilities))
    found = rows.agg(*(F.percentile_approx(v, wanted, accuracy).alias(f"q_{i}") for i, v in enumerate(values))).first()
    return {c: [float(v) for v in found[f"q_{i}"] or ()] for i, c in enumerate(columns)}


def exact_quantiles(
    rows: DataFrame, columns: Sequence[str], probabilities: Sequence[float]
) -> dict[str, list[float]]:
    """Linearly interpolated quantiles per column, equal to numpy's. Missing values do not count; a
    column without values gives []."""
    values = rows.select(*(nan_to_null(F.col(c).cast("double")).alias(c) for c in columns))
    inner = [q for q in probabilities if 0 < q < 1]
    around = F.array(*(F.lit(min(max(q + side * REACH, 0.0), 1.0)) for q in inner for side in (-1, 1)), F.lit(0.5))
    ends = values.agg(
        *(f(c).alias(f"{n}_{i}") for i, c in enumerate(columns) for n, f in (("n", F.count), ("low", F.min), ("high", F.max))),
        *(F.percentile_approx(c, around, SKETCH_ACCURACY).alias(f"near_{i}") for i, c in enumerate(columns)),
    ).first()
    sizes = {c: ends[f"n_{i}"] for i, c in enumerate(columns)}
    extremes = {c: (ends[f"low_{i}"], ends[f"high_{i}"]) for i, c in enumerate(columns) if sizes[c]}
    positions = {c: [q * (sizes[c] - 1) for q in probabilities] for c in extremes}
    seeds = {(c, q): tuple(ends[f"near_{i}"][2 * k : 2 * k + 2]) for i, c in enumerate(columns) if sizes[c] for k, q in enumerate(inner)}

    known: dict[tuple[str, int], float] = {}
    searches: dict[tuple[str, int], _Bracket] = {}
    for column, own in positions.items():
        for q, p in zip(probabilities, own):
            for rank in (math.floor(p), math.ceil(p)):
                if rank in (0, sizes[column] - 1):  # nothing is searched for the extremes
                    known[column, rank] = extremes[column][rank > 0]
                else:
                    searches[column, rank] = _Bracket(column, *seeds[column, q])
    while searches:
        found = _narrowed(values, searches)
        known |= {k: b.low for k, b in found.items() if b.low == b.high}
        searches = {k: b for k, b in found.items() if b.low < b.high}

    def between(column: str, position: float) -> float:
        low, high = (known[column, r] for r in (math.floor(position), math.ceil(position)))
        return float(np.quantile([low, high], position - math.floor(position)))

    return {c: [between(c, p) for p in positions.get(c, ())] for c in columns}


def _disjoint(brackets: Sequence[_Bracket]) -> list[_Bracket]:
    """The brackets of a column in order; those that touch are one."""
    out: list[_Bracket] = []
    for b in sorted(brackets, key=lambda b: (b.low, b.high)):
        if out and b.low <= out[-1].high:
            out[-1] = _Bracket(b.column, out[-1].low, max(out[-1].high, b.high))
        else:
            out.append(b)
    return out


def _narrowed(
    values: DataFrame, searches: Mapping[tuple[str, int], _Bracket]
) -> dict[tuple[str, int], _Bracket]:
    """One round: the part of its column that each rank falls into, a slice of a bracket or a gap between two."""
    columns = list(dict.fromkeys(c for c, _ in searches))
    brackets = {c: _disjoint([b for (own, _), b in searches.items() if own == c]) for c in columns}
    slices = max(LEAST_SLICES, ROUND_SLICES // sum(map(len, brackets.values())))

    def part(number: int, column: str) -> Column:
        """Of a value: the column's number, its zone (even: a gap, odd: a bracket), and the slice there."""
        x, own = F.col(column), brackets[column]
        zone = reduce(add, [(x >= F.lit(b.low)).cast("int") + (x > F.lit(b.high)).cast("int") for b in own])
        at = F.lit(0)
        for b in own:
            if b.low < b.high:
                at = F.when(x.between(F.lit(b.low), F.lit(b.high)), b.slice_of(slices)).otherwise(at)
        return F.when(x.isNotNull(), F.struct(F.lit(number).alias("of"), zone.alias("zone"), at.alias("slice"), x.alias("value")))

    members = F.array_compact(F.array(*(part(i, c) for i, c in enumerate(columns))))
    counted = (
        values.select(F.inline(members)).groupBy("of", "zone", "slice")
        .agg(F.count("*").alias("n"), F.min("value").alias("low"), F.max("value").alias("high"))
    )
    placed = counted.withColumn("upto", F.sum("n").over(Window.partitionBy("of").orderBy("zone", "slice")))
    asked = F.array(*(F.array(*(F.lit(rank).cast("long") for own, rank in searches if own == c)) for c in columns))
    hit = F.filter(F.get(asked, F.col("of")), lambda rank: (rank < F.col("upto")) & (rank >= F.col("upto") - F.col("n")))
    found = placed.select("of", F.explode(hit).alias("rank"), "low", "high")
    return {(columns[r["of"]], r["rank"]): _Bracket(columns[r["of"]], r["low"], r["high"]) for r in found.collect()}
