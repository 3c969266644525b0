"""Matching rows whose key may be written in several ways."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from premia.functions.skus import normalize_sku, sku_candidates
from premia.operators.ordering import keep_first


def first_candidate_match(
    rows: DataFrame, row_key: str, candidates: str, lookup: DataFrame, lookup_key: str, name: str
) -> DataFrame:
    """``rows`` plus a struct ``name`` from ``lookup``: the match of the first candidate that has one.

    ``row_key`` is unique in ``rows`` and ``lookup_key`` in ``lookup``; rows without a match get NULL.
    """
    # Only keys travel through the search; what was found is joined to the rows once.
    tried = rows.select(F.col(row_key).alias("_row"), F.posexplode(candidates).alias("_place", "_candidate"))
    codes = lookup.select(F.col(lookup_key).alias("_candidate"))
    found = tried.join(codes, "_candidate").groupBy("_row").agg(F.min_by("_candidate", "_place").alias("_match"))
    keyed = found.join(lookup.select(F.col(lookup_key).alias("_match"), F.struct("*").alias(name)), "_match").drop("_match")
    return rows.join(keyed, F.col(row_key) == F.col("_row"), "left").drop("_row")


def without_match(
    requests: DataFrame, request_key: str, sku: str, lookup: DataFrame, lookup_sku: str
) -> DataFrame:
    """Requests none of whose candidate keys is in ``lookup``."""
    known = lookup.select(normalize_sku(F.col(lookup_sku)).alias("_candidate")).distinct()
    tried = requests.select(
        request_key, F.explode(sku_candidates(F.col(sku))).alias("_candidate")
    )
    found = tried.join(known, "_candidate", "left_semi").select(request_key).distinct()
    return requests.join(found, request_key, "left_anti")


def requested_only(rows: DataFrame, key: str, requested: DataFrame | None) -> DataFrame:
    """Rows whose key is requested. No request frame means all rows, an empty one means none."""
    if requested is None:
        return rows
    return rows.join(requested.select(key), key, "left_semi")


def new_candidates(
    found: DataFrame, sku: str, ordinal: str, known: DataFrame, known_sku: str
) -> DataFrame:
    """Found rows whose normalised code is neither known nor found before, first one kept."""
    keyed = found.withColumn("_key", normalize_sku(F.col(sku))).where("_key <> ''")
    taken = known.select(normalize_sku(F.col(known_sku)).alias("_key"))
    return keep_first(keyed.join(taken, "_key", "left_anti"), ["_key"], ordinal).drop("_key")
