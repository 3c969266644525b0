"""Landing sources in the canonical layout.

A market snapshot is three feeds keyed by free-form codes: current prices (the anchor), release records
and a curated retail reference. A product lands only if retail, market price and release date are all
known; every other product is excluded with the first reason that applies.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from premia.functions.dates import canonical_date
from premia.functions.prices import first_non_empty, nan_to_null, positive_price, round_exact
from premia.functions.skus import normalize_sku, sku_candidates, stable_id
from premia.functions.text import brands_conflict, classify_release
from premia.operators.contract import coerce, table_types
from premia.operators.matching import first_candidate_match
from premia.operators.ordering import keep_first, keep_last, sequential_id
from premia.session import materialize
from premia.sources.writers import Store, land
from premia.spec import CANONICAL_SCHEMAS, SnapshotSpec

# Why a product is left out, in the order the reasons are tried.
EXCLUSION_REASONS = ["no_retail", "identity_mismatch", "no_market", "no_release_date"]


def merge_feeds(prices: DataFrame, releases: DataFrame) -> DataFrame:
    """Products of the price feed, first record per code, each with its release record.

    Both feeds carry ``ordinal``, their order at the source.
    """
    by_code = releases.withColumn("_code", normalize_sku(F.col("sku"))).where("_code <> ''")
    by_code = keep_first(by_code, ["_code"], "ordinal").select(
        "_code", "brand", "model", "name", "colorway", "release_date", "release_date_year"
    )
    anchors = prices.withColumn("normalized_sku", normalize_sku(F.col("sku")))
    anchors = keep_first(anchors.where("normalized_sku <> ''"), ["normalized_sku"], "ordinal")
    anchors = anchors.withColumn("_candidates", sku_candidates(F.col("sku")))
    matched = first_candidate_match(
        anchors, "normalized_sku", "_candidates", by_code, "_code", "_release"
    )

    def release(field: str) -> Column:
        return F.col(f"_release.{field}")

    return matched.select(
        "ordinal",
        "sku",
        "normalized_sku",
        "_candidates",
        first_non_empty(F.col("brand"), release("brand")).alias("brand"),
        first_non_empty(F.col("model"), release("model")).alias("model"),
        first_non_empty(release("colorway")).alias("colorway"),
        first_non_empty(F.col("title"), release("name")).alias("title"),
        first_non_empty(F.col("primary_title"), F.col("model")).alias("silhouette"),
        F.coalesce(F.col("id").cast("string"), F.lit("")).alias("product_id"),
        positive_price(F.col("avg_price")).alias("market_avg"),
        F.nullif(
            first_non_empty(release("release_date"), release("release_date_year")), F.lit("")
        ).alias("release_date"),
        F.coalesce("weekly_orders", F.lit(0)).cast("long").alias("weekly_orders"),
    )


def match_reference(products: DataFrame, reference: DataFrame) -> DataFrame:
    """Products plus their reference entry as struct ``ref`` (the last entry of a repeated code)."""
    entries = reference.withColumn("_code", normalize_sku(F.col("sku"))).where("_code <> ''")
    entries = keep_last(entries, ["_code"], "ordinal").drop("ordinal")
    return first_candidate_match(products, "normalized_sku", "_candidates", entries, "_code", "ref")


def with_exclusion(matched: DataFrame) -> DataFrame:
    """Adds ``release_text``, the release date to use, and ``excluded``, the reason or NULL."""
    release = F.coalesce(F.col("release_date"), F.nullif(F.col("ref.release_date"), F.lit("")))
    conditions = [
        # An entry without a price is no reference.
        ~F.coalesce((F.col("ref.retail_price") > 0) & ~F.isnan("ref.retail_price"), F.lit(False)),
        brands_conflict(F.col("ref.brand"), F.col("brand")),
        F.col("market_avg").isNull() | ~(F.col("market_avg") > 0),
        F.col("release_text").isNull(),
    ]
    reason = F.lit(None).cast("string")
    for name, applies in reversed(list(zip(EXCLUSION_REASONS, conditions))):
        reason = F.when(applies, name).otherwise(reason)
    return matched.withColumn("release_text", release).withColumn("excluded", reason)


def exclusion_counts(judged: DataFrame) -> DataFrame:
    """(reason, n) of the excluded products."""
    return judged.where("excluded IS NOT NULL").groupBy(F.col("excluded").alias("reason")).count() \
        .withColumnRenamed("count", "n")


def landed_products(judged: DataFrame) -> DataFrame:
    """Products that land, with the values their canonical rows are made of."""
    kept = judged.where("excluded IS NULL")
    code = normalize_sku(F.col("ref.sku"))
    return kept.select(
        "ordinal",
        "sku",
        code.alias("landed_sku"),
        stable_id(code).alias("shoe_id"),
        first_non_empty(F.col("ref.brand"), F.col("brand")).alias("brand"),
        first_non_empty(F.col("ref.model"), F.col("model")).alias("model"),
        first_non_empty(F.col("ref.colorway"), F.col("colorway")).alias("colorway"),
        F.col("ref.retail_price").alias("retail_price"),
        canonical_date(F.col("release_text"), invalid="raise").alias("release_date"),
        F.coalesce(
            F.nullif(F.col("ref.release_type"), F.lit("")), classify_release(F.col("title"))
        ).alias("release_type"),
        first_non_empty(F.col("ref.silhouette"), F.col("silhouette")).alias("silhouette"),
        F.col("market_avg").alias("sale_price"),
        F.col("product_id").alias("source_item_id"),
        "weekly_orders",
    )


def id_collisions(landed: DataFrame, key: str = "shoe_id") -> DataFrame:
    """(key, n) of ids shared by several landed products."""
    return landed.groupBy(key).agg(F.count("*").alias("n")).where("n > 1")


@dataclass(frozen=True)
class Landing:
    """The canonical tables of a snapshot, and what was left out."""

    tables: dict[str, DataFrame]
    exclusions: DataFrame
    collisions: DataFrame

    def verify(self) -> None:
        """Fail if two products share an id, or if nothing lands."""
        shared = self.collisions.first()
        if shared is not None:
            raise ValueError(f"{shared['n']} landed products share the id {shared['shoe_id']}")
        if self.tables["shoes"].isEmpty():
            counts = {r["reason"]: r["n"] for r in self.exclusions.collect()}
            raise ValueError(f"no product has retail, market price and release date: {counts}")


def snapshot_tables(
    landed: DataFrame, snapshot_date: str, spec: SnapshotSpec = SnapshotSpec()
) -> dict[str, DataFrame]:
    """The four canonical tables of the landed products; ``row_id`` numbers them."""
    day = F.lit(snapshot_date).cast("timestamp_ntz")
    sources = {
        "sales": {
            "sale_id": F.col("row_id"),
            "platform": F.lit(spec.platform),
            "sale_date": day,
            "size_us": F.lit(spec.size_us),
            "condition": F.lit(spec.condition),
        },
        "shoes": {},
        "drops": {
            "drop_id": F.col("row_id"),
            "drop_date": F.col("release_date"),
            "drop_type": F.col("release_type"),
            "announced_at": F.lit(None),
        },
        "search_interest": {
            "signal_date": day,
            "platform": F.lit(spec.signal_platform),
            "search_index": F.col("weekly_orders"),
        },
    }
    return {
        name: coerce(landed.withColumns(columns), table_types(name)) if columns
        else coerce(landed, table_types(name))
        for name, columns in sources.items()
    }


def land_snapshot(
    prices: DataFrame,
    releases: DataFrame,
    reference: DataFrame,
    snapshot_date: str,
    spec: SnapshotSpec = SnapshotSpec(),
) -> Landing:
    """The whole adapter. ``ordinal`` of the price feed must be a unique integer.

    The judged products are stored once, since six frames are read from them.
    """
    judged = with_exclusion(match_reference(merge_feeds(prices, releases), reference))
    judged = materialize(judged, "judged-products")
    landed = landed_products(judged)
    numbered = sequential_id(landed, "ordinal", "row_id")
    return Landing(
        snapshot_tables(numbered, snapshot_date, spec), exclusion_counts(judged), id_collisions(landed)
    )


def candidate_rows(found: DataFrame) -> DataFrame:
    """Proposed reference entries of found products, each with the seed it was found by.

    ``found`` has sku, title, brand, model, secondary_title, avg_price (text), and the seed's query, seed_brand, seed_model,
    seed_retail and seed_type. Retail comes from the seed; the seed's release type is raised to collab if the title names
    a collaborator. Types whose retail differs by colourway are marked for review. A market price that is
    no number is 0.
    """
    market = F.col("avg_price").try_cast("double")
    kind = F.when(classify_release(F.col("title")) == "collab", "collab").otherwise(F.col("seed_type"))
    return found.select(
        F.btrim(F.coalesce("sku", F.lit(""))).alias("sku"),
        F.col("seed_retail").cast("double").alias("retail_price"),
        kind.alias("release_type"),
        first_non_empty(F.col("seed_brand"), F.col("brand")).alias("brand"),
        first_non_empty(F.col("seed_model"), F.col("model")).alias("model"),
        first_non_empty(F.col("secondary_title"), F.col("title")).alias("colorway"),
        F.coalesce("seed_model", F.lit("")).alias("silhouette"),
        F.coalesce(round_exact(nan_to_null(market), 2), F.lit(0.0)).alias("market"),
        kind.isin("collab", "limited").alias("review"),
        "query",
    )


def land_tables(store: Store, tables: Mapping[str, DataFrame], run_date: str) -> DataFrame:
    """Write canonical tables to the raw zone and return their profile; if one is empty, none is landed."""
    return land(store, {name: tables[name] for name in CANONICAL_SCHEMAS}, "raw", run_date)
