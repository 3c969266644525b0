"""The list of registered queries and their oracle SQL."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from premia.session import tune

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None) -> Callable[[Query], Query]:
    """Register a query under a name, with the SQL that must give the same rows."""

    def register(build: Query) -> Query:
        @wraps(build)
        def tuned(spark: SparkSession, folder: str) -> DataFrame:
            return build(tune(spark), folder)

        QUERIES[name] = tuned
        if oracle is not None:
            ORACLES[name] = oracle
        return tuned

    return register


def rounded(rows: DataFrame, *columns: str, places: int = 6) -> DataFrame:
    """Computed doubles rounded, as the oracle does: sums in another order differ in the last bits."""
    return rows.withColumns({c: F.round(c, places) for c in columns})


def round_sql(value: str, places: int) -> str:
    """SQL that rounds by the exact binary value, ties to even."""
    return (
        f"(SELECT CASE WHEN rest > 0.5 OR (rest = 0.5 AND err > 0) OR (rest = 0.5 AND err = 0 AND "
        f"below % 2 = 1) THEN below + 1 ELSE below END / 1e{places} FROM (SELECT floor(p) AS below, "
        f"p - floor(p) AS rest, (h * 1e{places} - p) + (x - h) * 1e{places} AS err FROM (SELECT x, "
        f"x * 1e{places} AS p, x * 134217729.0::DOUBLE - (x * 134217729.0::DOUBLE - x) AS h "
        f"FROM (SELECT CAST({value} AS DOUBLE) AS x))))"
    )
