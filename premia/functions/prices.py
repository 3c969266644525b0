"""Price and category expressions. Each takes and returns Columns."""

from __future__ import annotations

from collections.abc import Mapping
from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F


def price_premium(sale: Column, retail: Column) -> Column:
    """Relative gain over retail; NULL when retail is 0 or missing."""
    return F.try_divide(sale - retail, retail)


def implied_resale(retail: Column, premium: Column) -> Column:
    """The resale price a premium stands for."""
    return retail * (F.lit(1.0) + premium)


def positive_price(raw: Column) -> Column:
    """The price if it parses and is above 0, else NULL. NaN is not a price."""
    price = raw.try_cast("double")
    return F.when((price > 0) & ~F.isnan(price), price)


def ordinal_encode(category: Column, ranks: Mapping[str, int], unmapped: str = "null") -> Column:
    """Rank of a category. An unmapped one gives NULL, or fails the job with ``unmapped='raise'``."""
    if unmapped not in ("null", "raise"):
        raise ValueError(f"unmapped must be 'null' or 'raise', not {unmapped!r}")
    lookup = F.create_map(*(F.lit(v) for v in chain.from_iterable(ranks.items())))
    rank = F.try_element_at(lookup, category)
    if unmapped == "null":
        return rank
    complaint = F.concat(F.lit("unmapped category: "), F.coalesce(category, F.lit("NULL")))
    return F.coalesce(rank, F.raise_error(complaint).cast("int"))


def first_non_empty(*candidates: Column) -> Column:
    """The first candidate that is neither NULL nor '', else ''."""
    return F.coalesce(*(F.nullif(c, F.lit("")) for c in candidates), F.lit(""))


def nan_to_null(value: Column) -> Column:
    """NaN means missing."""
    return F.nanvl(value, F.lit(None).cast("double"))


def round_exact(value: Column, places: int) -> Column:
    """Round to decimal places by the exact binary value, ties to even, as Python's ``round`` does.

    Spark's ``round`` goes by the shortest decimal form instead: it takes 2.675, which is a little less
    than that, for a tie. Here ``scaled + error`` is the product ``value * 10**places`` without loss
    (the value is split into two halves whose products are exact), so a near tie is told from a tie.
    NaN, infinities and values so large that they have no such places come back as they are.
    """
    factor = F.lit(float(10**places))
    scaled = value * factor
    near = F.rint(scaled)  # ties to even
    high = value * F.lit(134217729.0) - (value * F.lit(134217729.0) - value)
    error = (high * factor - scaled) + (value - high) * factor
    # What looks like a tie goes by the sign of the error, and to the even side if there is none.
    side = F.signum(F.signum(error) * 2 + (near - scaled))
    rounded = F.when(F.abs(near - scaled) == 0.5, scaled + side * 0.5).otherwise(near) / factor
    return F.when(F.abs(value) < F.lit(2.0**53 / 10**places), rounded).otherwise(value)
