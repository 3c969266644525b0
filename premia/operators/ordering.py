"""Operators that depend on an order. The order is always an explicit column, never row position."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from premia.session import materialize


def first_per_key(rows: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of every key by ``order``.

    Spark turns a filter on the first row number into a group limit in front of the shuffle, so each
    map task sends one row per key and a hot key stays small.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    return rows.withColumn("_rank", F.row_number().over(window)).where("_rank = 1").drop("_rank")


def keep_first(rows: DataFrame, keys: Sequence[str], ordinal: str) -> DataFrame:
    """First row per key in source order."""
    return first_per_key(rows, keys, [F.col(ordinal).asc()])


def keep_last(rows: DataFrame, keys: Sequence[str], ordinal: str) -> DataFrame:
    """Last row per key in source order."""
    return first_per_key(rows, keys, [F.col(ordinal).desc()])


def numbered(rows: DataFrame, order: Sequence[Column], name: str) -> DataFrame:
    """Number the rows from 1 by ``order``, which should leave no ties; rows that tie are numbered as they come.

    The rows are sorted by range over all tasks and stored with their place inside their task; a task's rows follow those of
    the tasks before it, whose counts alone are added up (a row per task). The first number of each task is joined to its rows.
    """
    place = F.monotonically_increasing_id()  # the task in the upper bits, the row's place in the lower 33
    ordered = rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_place", place)
    stored = materialize(ordered, "ordered").withColumn("_task", F.shiftright("_place", 33))
    before = Window.orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    starts = stored.groupBy("_task").agg(F.count("*").alias("_n")).select("_task", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    within = F.col("_place").bitwiseAND((1 << 33) - 1)
    return stored.join(starts, "_task").withColumn(name, F.col("_start") + within + 1).drop("_task", "_place", "_start")


def sequential_id(rows: DataFrame, ordinal: str, name: str) -> DataFrame:
    """Number the rows 1..n by a unique ``ordinal``, whatever its values and gaps."""
    return numbered(rows, [F.col(ordinal)], name)
