"""The ranked board of scored products and its trend."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from premia.functions.prices import price_premium, round_exact
from premia.functions.text import strip
from premia.operators.quantiles import exact_quantiles
from premia.session import materialize
from premia.spec import HISTORY_CAP


def ranked_board(scored: DataFrame, tiebreak: str = "shoe_id") -> DataFrame:
    """Scored products by predicted premium, highest first; money to 2 places, premium to 4."""
    raw = scored.select(
        "brand", "model", "colorway", "retail_price", "sale_price", "implied_resale", F.col(tiebreak),
        round_exact(F.col("predicted_premium"), 4).alias("premium"),
    )
    # The sort evaluates its input twice, so only its key is computed ahead of it.
    return raw.orderBy(F.desc("premium"), F.asc(tiebreak)).select(
        F.trim(F.concat_ws(" ", "brand", "model")).alias("name"),
        strip(F.col("colorway")).alias("note"),
        round_exact(F.col("retail_price"), 2).alias("retail"),
        round_exact(F.col("sale_price"), 2).alias("market"),
        "premium",
        round_exact(F.col("implied_resale"), 2).alias("implied_resale"),
        tiebreak,
    )


def median_trend(board: DataFrame) -> DataFrame:
    """One row: size of the board and the median predicted and median market premium.

    Medians, because a few products trading at many times retail would carry a mean away.
    """
    premiums = board.select(
        F.col("premium").alias("model_premium"),
        price_premium(F.col("market"), F.col("retail")).alias("market_premium"),
    )
    # Stored without order: the search for the medians reads it several times.
    premiums = materialize(premiums, "board-premiums")
    medians = exact_quantiles(premiums, ["model_premium", "market_premium"], [0.5])
    points = {c: round_exact(F.lit(v[0] if v else None).cast("double"), 4) for c, v in medians.items()}
    return premiums.agg(F.count("*").alias("n")).select("n", *(p.alias(c) for c, p in points.items()))


def capped_history(
    history: DataFrame, points: DataFrame, order: Sequence[str] = ("ts",), cap: int = HISTORY_CAP
) -> DataFrame:
    """History plus new points, cut to the most recent ``cap``; ``order`` must be a total order."""
    return history.unionByName(points).orderBy(*(F.desc(c) for c in order)).limit(cap)
