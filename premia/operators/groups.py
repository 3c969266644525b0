"""Group statistics joined back onto rows.

A window over a whole group keeps that group in one task, so a key holding a third of the rows would
stall the job. Here the statistic is aggregated first, with partial aggregation in every map task, and
joined back: the join side has one row per key, so Spark broadcasts it when it is small at run time and
otherwise splits hot keys as a skewed join.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def attach(
    rows: DataFrame,
    stats: DataFrame,
    keys: Sequence[str],
    how: str = "left",
    null_safe: bool = False,
) -> DataFrame:
    """Join one-row-per-key ``stats`` onto ``rows``.

    With ``null_safe`` a NULL key is a key like any other, as in a window partition; without, it
    matches nothing.
    """
    if not null_safe:
        return rows.join(stats, list(keys), how)
    other = stats.withColumnsRenamed({k: f"_{k}_key" for k in keys})
    same = reduce(Column.__and__, (F.col(k).eqNullSafe(F.col(f"_{k}_key")) for k in keys))
    return rows.join(other, same, how).drop(*(f"_{k}_key" for k in keys))


def dimension_join(facts: DataFrame, dimension: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """Inner join of facts with the named columns of a dimension; a repeated key fans out."""
    return facts.join(dimension.select(key, *columns), key, "inner")


def group_mean(rows: DataFrame, keys: Sequence[str], value: str, name: str) -> DataFrame:
    """One row per key with the mean of ``value``."""
    return rows.groupBy(*keys).agg(F.avg(value).alias(name))


def attach_group_mean(
    rows: DataFrame, keys: Sequence[str], value: str, name: str, null_safe: bool = False
) -> DataFrame:
    """Every row plus the mean of ``value`` in its group."""
    return attach(rows, group_mean(rows, keys, value, name), keys, null_safe=null_safe)


def attach_group_min(
    rows: DataFrame, keys: Sequence[str], value: str, name: str, null_safe: bool = True
) -> DataFrame:
    """Every row plus the smallest ``value`` in its group."""
    smallest = rows.groupBy(*keys).agg(F.min(value).alias(name))
    return attach(rows, smallest, keys, null_safe=null_safe)


def attach_contrast(
    rows: DataFrame, coarse: Sequence[str], fine: Sequence[str], value: str, name: str
) -> DataFrame:
    """Every row plus the mean over its fine group minus the mean over its coarse group.

    The coarse means are built from the fine totals, so the rows are aggregated once.
    """
    totals = rows.groupBy(*coarse, *fine).agg(
        F.sum(value).alias("_total"), F.count(value).alias("_n")
    )
    base = totals.groupBy(*coarse).agg(mean_of_totals("_total", "_n").alias("_base"))
    contrast = attach(totals, base, coarse, null_safe=True).select(
        *coarse, *fine, (F.try_divide("_total", "_n") - F.col("_base")).alias(name)
    )
    return attach(rows, contrast, [*coarse, *fine], null_safe=True)


def mean_of_totals(total: str, n: str) -> Column:
    """The mean of the rows behind partial totals, as an aggregate."""
    return F.try_divide(F.sum(total), F.sum(n))
