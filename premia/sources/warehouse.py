"""A star-schema warehouse as canonical tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from premia.operators.ordering import first_per_key

# --- Fixed values: canonical column <- warehouse column, with its type ---------------------------
SALES_MAPPING = {
    "sale_id": ("sale_key", "long"),
    "shoe_id": ("shoe_key", "long"),
    "platform": ("source", "string"),
    "sale_price": ("sold_price", "double"),
    "sale_date": ("sold_date", "timestamp_ntz"),
    "size_us": ("size", "double"),
    "condition": ("condition", "string"),
    "source_item_id": ("source_item_id", "string"),
}
DROPS_MAPPING = {
    "drop_id": ("drop_key", "long"),
    "shoe_id": ("shoe_key", "long"),
    "drop_date": ("release_date", "timestamp_ntz"),
    "drop_type": ("release_type", "string"),
    "announced_at": (None, "timestamp_ntz"),
}
SEARCH_MAPPING = {
    "shoe_id": ("shoe_key", "long"),
    "signal_date": ("point_date", "timestamp_ntz"),
    "platform": ("geo", "string"),
    "search_index": ("interest", "long"),
}
SHOES_MAPPING = {
    "shoe_id": ("shoe_key", "long"),
    "brand": ("brand", "string"),
    "model": ("model_name", "string"),
    "colorway": ("colorway", "string"),
    "retail_price": ("retail_price", "double"),
    "release_date": ("release_date", "timestamp_ntz"),
    "release_type": ("release_type", "string"),
    "silhouette": ("silhouette", "string"),
}


def canonical_project(rows: DataFrame, mapping: dict[str, tuple[str | None, str]]) -> DataFrame:
    """Rename and cast to the canonical layout, in its column order."""

    def source(name: str | None) -> Column:
        return F.lit(None) if name is None else F.col(name)

    return rows.select(*(source(name).cast(kind).alias(c) for c, (name, kind) in mapping.items()))


def canonical_drop(drops: DataFrame, key: str, date: str, tiebreak: Sequence[str]) -> DataFrame:
    """The earliest drop per product; ``tiebreak`` makes the choice among equal dates definite."""
    return first_per_key(drops, [key], [F.col(date).asc_nulls_last(), *(F.col(t).asc() for t in tiebreak)])


def canonical_tables(
    fact_sales: DataFrame, dim_shoes: DataFrame, dim_drops: DataFrame, fact_search: DataFrame
) -> dict[str, DataFrame]:
    """The four canonical tables. A product without a drop has no retail price and is left out."""
    first_drop = canonical_drop(dim_drops, "shoe_key", "release_date", ["drop_key"])
    shoes = dim_shoes.join(
        first_drop.select("shoe_key", "release_date", "retail_price", "release_type"), "shoe_key"
    )
    return {
        "sales": canonical_project(fact_sales, SALES_MAPPING),
        "shoes": canonical_project(shoes, SHOES_MAPPING),
        "drops": canonical_project(dim_drops, DROPS_MAPPING),
        "search_interest": canonical_project(fact_search, SEARCH_MAPPING),
    }
