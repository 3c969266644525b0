"""Queries over sources, codes, matching and the landing of a market snapshot."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from premia.catalog import feeds
from premia.catalog import tables as T
from premia.catalog.registry import query, round_sql, rounded
from premia.functions.dates import canonical_date
from premia.functions.prices import first_non_empty, positive_price
from premia.functions.skus import normalize_sku, sku_candidates, stable_id
from premia.functions.text import brands_conflict, classify_release
from premia.operators.matching import new_candidates, requested_only, without_match
from premia.operators.ordering import first_per_key, keep_first, keep_last, sequential_id
from premia.plans.landing import (
    candidate_rows,
    exclusion_counts,
    id_collisions,
    land_snapshot,
    landed_products,
    match_reference,
    merge_feeds,
    with_exclusion,
)
from premia.session import materialize, scratch_path
from premia.sources.readers import explode_envelope, scan_json, scan_parquet, trim_fields
from premia.sources.warehouse import (
    DROPS_MAPPING,
    SALES_MAPPING,
    canonical_drop,
    canonical_project,
)
from premia.sources.writers import (
    Store,
    land,
    of_runs,
    write_partitioned,
    write_report,
)

SNAPSHOT_DATE = "2026-07-04"
# Records of a feed file at most: a file is one value of one task.
FEED_RECORDS = 10_000

# --- Sources and sinks --------------------------------------------------------------------------


@query("scan_parquet", """
SELECT l_orderkey, l_partkey, l_linenumber, l_quantity FROM lineitem WHERE l_shipdate >= '1999-01-01'""")
def scan_parquet_query(spark, folder):
    columns = ["l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_shipdate"]
    items = scan_parquet(spark, f"{folder}/lineitem.parquet", columns)
    return items.where("l_shipdate >= TIMESTAMP_NTZ '1999-01-01'").drop("l_shipdate")


@query("scan_json_envelope", """
SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events""")
def scan_json_envelope_query(spark, folder):
    documents = T.table(spark, folder, "events").selectExpr(
        "event_id",
        "CASE WHEN event_type = 'view' THEN concat('[', props, ']') "
        "ELSE concat('{\"data\": [', props, ']}') END AS body",
    )
    return explode_envelope(documents, "body", "k LONG", ["event_id"]).select("event_id", "k")


@query("scan_json_files", """
SELECT p_partkey, p_brand, p_retailprice, p_size, row_number() OVER (ORDER BY p_partkey) - 1 AS place FROM part""")
def scan_json_files_query(spark, folder):
    """Parts in eight feed files or more, lists and envelopes by turns, read back; their place across the files."""
    path = scratch_path(spark, "part-feed")
    parts = T.table(spark, folder, "part").select("p_partkey", "p_brand", "p_retailprice", "p_size")
    # Sorted by key over the files, so that file and place give the order of the keys; sizes as 12.0.
    record = F.struct("p_partkey", "p_brand", "p_retailprice", F.col("p_size").cast("double").alias("p_size"))
    numbered = materialize(sequential_id(parts, "p_partkey", "ordinal"), "numbered-parts")
    held = max(1, min(FEED_RECORDS, -(-numbered.count() // 8)))
    files = numbered.withColumn("file", F.expr(f"(ordinal - 1) div {held}")).groupBy("file").agg(
        F.to_json(F.array_sort(F.collect_list(record))).alias("list")
    )
    document = F.when(F.col("file") % 2 == 0, F.col("list")).otherwise(F.concat(F.lit('{"data": '), "list", F.lit("}")))
    named = files.select(F.col("file"), document.alias("value"))
    named.write.partitionBy("file").text(path)
    rows = scan_json(spark, path, "p_partkey LONG, p_brand STRING, p_retailprice DOUBLE, p_size LONG")
    # Each file's records come before the next file's: their sizes give the start.
    sizes = rows.groupBy("_file").agg(F.count("*").alias("n"), F.min("p_partkey").alias("first"))
    before = Window.orderBy("first").rowsBetween(Window.unboundedPreceding, -1)  # a row per file
    starts = sizes.select("_file", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    return rows.join(starts, "_file").select(
        "p_partkey", "p_brand", "p_retailprice", "p_size", (F.col("start") + F.col("position")).alias("place")
    )


@query("trim_fields", "SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders")
def trim_fields_query(spark, folder):
    orders = T.table(spark, folder, "orders")
    return trim_fields(orders, ["o_orderkey", "o_orderstatus", "colorway", "o_totalprice"])


@query("canonical_project", """
SELECT l_orderkey AS sale_id, l_partkey AS shoe_id, l_returnflag AS platform,
       CAST(l_extendedprice AS DOUBLE) AS sale_price, l_shipdate AS sale_date,
       CAST(l_linenumber AS DOUBLE) AS size_us, l_linestatus AS condition,
       CAST(l_suppkey AS VARCHAR) AS source_item_id
FROM lineitem""")
def canonical_project_query(spark, folder):
    fact_sales = T.table(spark, folder, "lineitem").selectExpr(
        "l_orderkey AS sale_key", "l_partkey AS shoe_key", "l_returnflag AS source",
        "l_extendedprice AS sold_price", "l_shipdate AS sold_date",
        "l_linenumber AS size", "l_linestatus AS condition", "l_suppkey AS source_item_id",
    )
    return canonical_project(fact_sales, SALES_MAPPING)


@query("canonical_project_drops", """
SELECT o_orderkey AS drop_id, o_custkey AS shoe_id, o_orderdate AS drop_date,
       o_orderpriority AS drop_type, CAST(NULL AS TIMESTAMP) AS announced_at FROM orders""")
def canonical_project_drops_query(spark, folder):
    dim_drops = T.table(spark, folder, "orders").selectExpr(
        "o_orderkey AS drop_key", "o_custkey AS shoe_key", "o_orderdate AS release_date",
        "o_orderpriority AS release_type",
    )
    return canonical_project(dim_drops, DROPS_MAPPING)


@query("canonical_drop", f"WITH {T.DROPS_SQL}" + """
SELECT p_partkey AS shoe_id, p_brand AS brand, drop_id, drop_date
FROM part JOIN (
  SELECT * FROM drops QUALIFY row_number() OVER (PARTITION BY shoe_id ORDER BY drop_date, drop_id) = 1
) d ON d.shoe_id = p_partkey""")
def canonical_drop_query(spark, folder):
    first = canonical_drop(T.drops(spark, folder), "shoe_id", "drop_date", ["drop_id"])
    parts = T.table(spark, folder, "part").selectExpr("p_partkey AS shoe_id", "p_brand AS brand")
    return parts.join(first.select("shoe_id", "drop_id", "drop_date"), "shoe_id")


def _canonical_tables(spark, folder):
    return {
        "sales": T.item_sales(spark, folder),
        "shoes": T.shoes(spark, folder),
        "drops": T.drops(spark, folder),
        "search_interest": T.item_signals(spark, folder),
    }


_TABLE_COUNTS = f"""WITH {T.SHOES_SQL}, {T.ITEM_SALES_SQL}, {T.ITEM_SIGNALS_SQL},
counts AS (
  SELECT 'sales' AS "table", 8 AS column_count, count(*) AS n FROM sales UNION ALL
  SELECT 'shoes', 8, count(*) FROM shoes UNION ALL
  SELECT 'drops', 5, count(*) FROM drops UNION ALL
  SELECT 'search_interest', 4, count(*) FROM signals)"""


@query("landing_profile", _TABLE_COUNTS + """
SELECT "table", CAST(column_count AS BIGINT) AS column_count, n AS rows FROM counts""")
def landing_profile_query(spark, folder):
    """The canonical tables landed as a run; the profile comes from what was counted while they were written."""
    profile = land(Store(scratch_path(spark, "store")), _canonical_tables(spark, folder), "raw", "2020-01-01")
    return profile.select("table", F.col("column_count").cast("long").alias("column_count"), "rows")


@query("non_empty_guard", _TABLE_COUNTS + """
SELECT "table", n > 0 AS may_land, false AS may_land_emptied FROM counts""")
def non_empty_guard_query(spark, folder):
    """The guard's outcome for every table, as it is and without its rows: a refused table leaves no run behind."""
    store, run_date = Store(scratch_path(spark, "store")), "2020-01-01"

    def may_land(name, rows):
        try:
            land(store, {name: rows}, "raw", run_date)
        except ValueError:
            return False
        return True

    outcomes = [
        (name, may_land(name, rows), may_land(f"{name}_emptied", rows.where("false")))
        for name, rows in _canonical_tables(spark, folder).items()
    ]
    return spark.createDataFrame(outcomes, "table STRING, may_land BOOLEAN, may_land_emptied BOOLEAN")


@query("write_parquet_partitioned", """
SELECT p_brand, count(*) AS n, round(sum(p_retailprice), 4) AS retail FROM part GROUP BY p_brand""")
def write_parquet_partitioned_query(spark, folder):
    path = scratch_path(spark, "parts")
    write_partitioned(T.table(spark, folder, "part"), path, ["p_brand"])
    written = spark.read.parquet(path)
    return written.groupBy("p_brand").agg(
        F.count("*").alias("n"), F.round(F.sum("p_retailprice"), 4).alias("retail")
    )


@query("write_report", """
SELECT count(*) AS n_orders, round(avg(o_totalprice), 4) AS mean_price FROM orders""")
def write_report_query(spark, folder):
    path = scratch_path(spark, "report")
    report = T.table(spark, folder, "orders").agg(
        F.count("*").alias("n_orders"), F.round(F.avg("o_totalprice"), 4).alias("mean_price")
    )
    write_report(spark, report, path)
    return spark.read.schema("n_orders LONG, mean_price DOUBLE").json(path)


_ORDER_RUNS = "SELECT *, date_trunc('year', o_orderdate)::DATE AS run_date FROM orders"


@query("run_partition", """
SELECT o_orderkey, o_orderstatus FROM orders WHERE year(o_orderdate) = 1998""")
def run_partition_query(spark, folder):
    """Every year of orders landed as one run; one run read back."""
    store = Store(scratch_path(spark, "store"))
    store.update(_order_runs(spark, folder), "raw", "orders", ["run_date"])
    return store.read(spark, "raw", "orders", "1998-01-01").select("o_orderkey", "o_orderstatus")


def _order_runs(spark, folder):
    return T.table(spark, folder, "orders").withColumn("run_date", F.trunc(F.to_date("o_orderdate"), "year"))


@query("run_partition_update", f"""
WITH runs AS ({_ORDER_RUNS}),
updated AS (
  SELECT run_date, o_orderpriority, o_orderkey,
         CASE WHEN year(o_orderdate) = 1996 AND o_orderpriority IN ('1-URGENT', '5-LOW') THEN 2 * o_totalprice ELSE o_totalprice END AS price
  FROM runs WHERE NOT (year(o_orderdate) = 1996 AND o_orderpriority = '5-LOW' AND o_orderkey % 2 = 0))
SELECT CAST(run_date AS VARCHAR) AS run_date, o_orderpriority, count(*) AS n, round(sum(price), 2) AS total FROM updated
WHERE o_orderpriority IN ('1-URGENT', '5-LOW', '2-HIGH') AND year(run_date) >= 1995 GROUP BY ALL""")
def run_partition_update_query(spark, folder):
    """Runs by year and priority; a rerun replaces two partitions of one run; several runs and priorities are read by partition."""
    store, keys = Store(scratch_path(spark, "store")), ["run_date", "o_orderpriority"]
    runs = _order_runs(spark, folder)
    store.update(runs, "raw", "orders", keys)
    again = runs.where("year(o_orderdate) = 1996 AND o_orderpriority IN ('1-URGENT', '5-LOW') AND NOT (o_orderpriority = '5-LOW' AND o_orderkey % 2 = 0)")
    store.update(again.withColumn("o_totalprice", F.col("o_totalprice") * 2), "raw", "orders", keys)
    table = store.table(spark, "raw", "orders")
    # The priorities come from a table, so which of them to read is known at run time only.
    priorities = T.table(spark, folder, "orders").groupBy("o_orderpriority").agg(F.count("*").alias("orders"))
    asked = materialize(priorities, "priorities").where("substring(o_orderpriority, 1, 1) IN ('1', '2', '5')")
    return of_runs(table, "1995-01-01", asked, "o_orderpriority").groupBy(F.col("run_date").cast("string").alias("run_date"), "o_orderpriority").agg(
        F.count("*").alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total")
    )


# --- Codes and text -----------------------------------------------------------------------------

_ITEM_SKU = "concat(' ', l_returnflag, '_x ', l_partkey, '.-', l_linestatus, '/', l_suppkey, '/')"


@query("normalize_sku", f"""
SELECT l_orderkey, l_linenumber, {feeds.normalize_sql(_ITEM_SKU)} AS sku FROM lineitem""")
def normalize_sku_query(spark, folder):
    return T.table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", normalize_sku(F.expr(_ITEM_SKU)).alias("sku")
    )


@query("normalize_text", f"SELECT doc_id, md5({feeds.normalize_sql('text')}) AS digest FROM documents")
def normalize_text_query(spark, folder):
    """The same rule over whole documents in several languages."""
    return T.table(spark, folder, "documents").select(
        "doc_id", F.md5(F.encode(normalize_sku(F.col("text")), "UTF-8")).alias("digest")
    )


@query("sku_candidates", f"""
WITH prices AS (SELECT o_orderkey, {feeds._RAW_SKU} AS sku FROM orders),
tried AS ({feeds.candidates_sql('prices', 'o_orderkey', 'sku')}),
distinct_tried AS (
  SELECT o_orderkey, candidate, min(place) AS place FROM tried WHERE candidate <> '' GROUP BY ALL)
SELECT o_orderkey, string_agg(candidate, '|' ORDER BY place) AS candidates
FROM distinct_tried GROUP BY o_orderkey""")
def sku_candidates_query(spark, folder):
    feed = feeds.prices(spark, folder)
    joined = F.array_join(sku_candidates(F.col("sku")), "|")
    return feed.select(F.col("ordinal").alias("o_orderkey"), joined.alias("candidates"))


@query("stable_id", f"""
SELECT l_orderkey, l_linenumber, CAST({feeds.crc32_sql(feeds.normalize_sql(_ITEM_SKU))} AS BIGINT) AS id
FROM lineitem""")
def stable_id_query(spark, folder):
    return T.table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", stable_id(normalize_sku(F.expr(_ITEM_SKU))).alias("id")
    )


@query("classify_text", f"SELECT doc_id, {feeds.class_sql('text')} AS class FROM documents")
def classify_text_query(spark, folder):
    return T.table(spark, folder, "documents").select(
        "doc_id", classify_release(F.col("text")).alias("class")
    )


_DATE_TEXT = """CASE o_orderstatus
    WHEN 'O' THEN concat(substr(CAST(o_orderdate AS {text}), 1, 10), 'T23:59:59.999Z')
    WHEN 'F' THEN substr(CAST(o_orderdate AS {text}), 1, 4)
    ELSE substr(CAST(o_orderdate AS {text}), 1, 10) END"""


@query("canonical_date", f"""
WITH raw AS (SELECT o_orderkey, {_DATE_TEXT.format(text='VARCHAR')} AS txt FROM orders)
SELECT o_orderkey, {feeds.date_sql('txt')} AS day FROM raw""")
def canonical_date_query(spark, folder):
    text = F.expr(_DATE_TEXT.format(text="STRING"))
    return T.table(spark, folder, "orders").select("o_orderkey", canonical_date(text).alias("day"))


@query("brand_guard", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
       a.p_brand <> b.p_brand AND length(b.p_name) % 2 = 0 AS conflict
FROM lineitem JOIN part a ON a.p_partkey = l_partkey JOIN part b ON b.p_partkey = l_suppkey""")
def brand_guard_query(spark, folder):
    parts = T.table(spark, folder, "part")
    items = T.table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"
    )
    left = parts.selectExpr("p_partkey AS l_partkey", "concat(' ', upper(p_brand)) AS left_brand")
    right = parts.selectExpr(
        "p_partkey AS l_suppkey",
        "CASE WHEN length(p_name) % 2 = 0 THEN lower(p_brand) ELSE ' ' END AS right_brand",
    )
    joined = items.join(left, "l_partkey").join(right, "l_suppkey")
    conflict = brands_conflict(F.col("left_brand"), F.col("right_brand")).alias("conflict")
    return joined.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", conflict)


@query("first_non_empty", f"""
WITH {feeds.FEEDS_SQL}
SELECT ordinal, coalesce(nullif(brand, ''), nullif(model, ''), nullif(title, ''), '') AS label
FROM prices""")
def first_non_empty_query(spark, folder):
    label = first_non_empty(F.col("brand"), F.col("model"), F.col("title"))
    return feeds.prices(spark, folder).select("ordinal", label.alias("label"))


@query("positive_price", f"""
WITH {feeds.FEEDS_SQL}
SELECT ordinal, CASE WHEN TRY_CAST(avg_price AS DOUBLE) > 0 THEN TRY_CAST(avg_price AS DOUBLE) END AS price
FROM prices""")
def positive_price_query(spark, folder):
    return feeds.prices(spark, folder).select(
        "ordinal", positive_price(F.col("avg_price")).alias("price")
    )


# --- Order and matching -------------------------------------------------------------------------


@query("keep_first", """
SELECT event_id, user_id, event_type, ts, value FROM events
QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id) = 1""")
def keep_first_query(spark, folder):
    events = T.table(spark, folder, "events").drop("props")
    return keep_first(events, ["user_id", "event_type"], "event_id")


@query("keep_last", """
SELECT o_orderkey, o_custkey, o_totalprice FROM orders
QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey DESC) = 1""")
def keep_last_query(spark, folder):
    orders = T.table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return keep_last(orders, ["o_custkey"], "o_orderkey")


@query("top1_per_key", """
SELECT l_partkey, l_orderkey, l_linenumber, l_suppkey, l_extendedprice FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_partkey
  ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber, l_suppkey) = 1""")
def top1_per_key_query(spark, folder):
    items = T.table(spark, folder, "lineitem").select(
        "l_partkey", "l_orderkey", "l_linenumber", "l_suppkey", "l_extendedprice"
    )
    order = [F.desc("l_extendedprice"), F.asc("l_orderkey"), F.asc("l_linenumber"), F.asc("l_suppkey")]
    return first_per_key(items, ["l_partkey"], order)


@query("sequential_id", """
SELECT event_id, row_number() OVER (ORDER BY event_id) AS row_id FROM events WHERE event_type <> 'error'""")
def sequential_id_query(spark, folder):
    kept = T.table(spark, folder, "events").where("event_type <> 'error'").select("event_id")
    return sequential_id(kept, "event_id", "row_id")


def _merged(spark, folder):
    return merge_feeds(feeds.prices(spark, folder), feeds.releases(spark, folder))


def _judged(spark, folder):
    return with_exclusion(match_reference(_merged(spark, folder), feeds.reference(spark, folder)))


_MERGED_COLUMNS = [
    "ordinal", "sku", "normalized_sku", "brand", "model", "colorway", "title", "silhouette",
    "product_id", "market_avg", "release_date", "weekly_orders",
]


@query("sku_match_join", f"WITH {feeds.MERGED_SQL} SELECT {', '.join(_MERGED_COLUMNS)} FROM merged")
def sku_match_join_query(spark, folder):
    return _merged(spark, folder).select(*_MERGED_COLUMNS)


@query("reference_lookup", f"""
WITH {feeds.JUDGED_SQL} SELECT normalized_sku, ref_code, retail_price FROM judged""")
def reference_lookup_query(spark, folder):
    return match_reference(_merged(spark, folder), feeds.reference(spark, folder)).select(
        "normalized_sku",
        normalize_sku(F.col("ref.sku")).alias("_code"),
        F.col("ref.retail_price").alias("retail_price"),
    ).withColumn("ref_code", F.nullif("_code", F.lit(""))).drop("_code")


@query("exclusion_counts", f"""
WITH {feeds.JUDGED_SQL}
SELECT excluded AS reason, count(*) AS n FROM judged WHERE excluded IS NOT NULL GROUP BY excluded""")
def exclusion_counts_query(spark, folder):
    return exclusion_counts(_judged(spark, folder))


@query("id_collision_check", f"""
WITH {feeds.LANDED_SQL} SELECT landed_sku, count(*) AS n FROM landed GROUP BY landed_sku HAVING count(*) > 1""")
def id_collision_check_query(spark, folder):
    return id_collisions(landed_products(_judged(spark, folder)), "landed_sku")


def _landing(spark, folder):
    return land_snapshot(
        feeds.prices(spark, folder), feeds.releases(spark, folder), feeds.reference(spark, folder),
        SNAPSHOT_DATE,
    )


@query("snapshot_reshape", f"""
WITH {feeds.LANDED_SQL}
SELECT row_id AS sale_id, shoe_id, 'StockX' AS platform, sale_price,
       CAST('{SNAPSHOT_DATE}' AS TIMESTAMP) AS sale_date, CAST(9 AS DOUBLE) AS size_us,
       'new' AS condition, source_item_id
FROM landed""")
def snapshot_reshape_query(spark, folder):
    return _landing(spark, folder).tables["sales"]


@query("snapshot_reshape_shoes", f"""
WITH {feeds.LANDED_SQL}
SELECT shoe_id, brand, model, colorway, retail_price, release_date, release_type, silhouette FROM landed""")
def snapshot_reshape_shoes_query(spark, folder):
    return _landing(spark, folder).tables["shoes"]


@query("snapshot_reshape_drops", f"""
WITH {feeds.LANDED_SQL}
SELECT row_id AS drop_id, shoe_id, release_date AS drop_date, release_type AS drop_type,
       CAST(NULL AS TIMESTAMP) AS announced_at
FROM landed""")
def snapshot_reshape_drops_query(spark, folder):
    return _landing(spark, folder).tables["drops"]


@query("snapshot_reshape_search", f"""
WITH {feeds.LANDED_SQL}
SELECT shoe_id, CAST('{SNAPSHOT_DATE}' AS TIMESTAMP) AS signal_date,
       'market_weekly_orders' AS platform, weekly_orders AS search_index
FROM landed""")
def snapshot_reshape_search_query(spark, folder):
    return _landing(spark, folder).tables["search_interest"]


@query("uncomputable_anti", f"""
WITH {feeds.FEEDS_SQL},
tried AS ({feeds.candidates_sql('prices', 'ordinal', 'sku')})
SELECT ordinal, sku FROM prices WHERE ordinal NOT IN (
  SELECT ordinal FROM tried WHERE candidate <> ''
    AND candidate IN (SELECT {feeds.normalize_sql('sku')} FROM reference))""")
def uncomputable_anti_query(spark, folder):
    requests = feeds.prices(spark, folder).select("ordinal", "sku")
    return without_match(requests, "ordinal", "sku", feeds.reference(spark, folder), "sku")


@query("requested_semi", """
SELECT l_orderkey, l_partkey, l_linenumber FROM lineitem
WHERE l_partkey IN (SELECT p_partkey FROM part WHERE p_type = 'PROMO')""")
def requested_semi_query(spark, folder):
    wanted = T.table(spark, folder, "part").where("p_type = 'PROMO'").selectExpr("p_partkey AS l_partkey")
    items = T.table(spark, folder, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber")
    return requested_only(items, "l_partkey", wanted)


@query("new_candidate_anti", f"""
WITH {feeds.FEEDS_SQL}
SELECT ordinal, sku, avg_price FROM prices
WHERE {feeds.normalize_sql('sku')} <> ''
  AND {feeds.normalize_sql('sku')} NOT IN (SELECT {feeds.normalize_sql('sku')} FROM reference)
QUALIFY row_number() OVER (PARTITION BY {feeds.normalize_sql('sku')} ORDER BY ordinal) = 1""")
def new_candidate_anti_query(spark, folder):
    found = feeds.prices(spark, folder).select("ordinal", "sku", "avg_price")
    return new_candidates(found, "sku", "ordinal", feeds.reference(spark, folder), "sku")


_SEEDS = {
    "query": "n_name", "seed_brand": "CASE WHEN n_regionkey = 2 THEN '' ELSE n_name END",
    "seed_model": "CASE WHEN n_regionkey = 3 THEN NULL ELSE concat('Model ', n_nationkey) END",
    "seed_retail": "100 + n_nationkey", "seed_type": "CASE WHEN n_nationkey % 2 = 0 THEN 'limited' ELSE 'general' END",
}
_FOUND_TITLE = "CASE WHEN ordinal % 3 = 0 THEN title ELSE 'Plain Name' END"
_SEED_COLUMNS = ", ".join(f"{e} AS {c}" for c, e in _SEEDS.items())


@query("candidate_rows", f"""
WITH {feeds.FEEDS_SQL},
found AS (
  SELECT * FROM prices WHERE {feeds.normalize_sql('sku')} <> ''
    AND {feeds.normalize_sql('sku')} NOT IN (SELECT {feeds.normalize_sql('sku')} FROM reference)
  QUALIFY row_number() OVER (PARTITION BY {feeds.normalize_sql('sku')} ORDER BY ordinal) = 1),
titled AS (
  SELECT ordinal, trim(sku) AS sku, {_FOUND_TITLE} AS title, brand, model, TRY_CAST(avg_price AS DOUBLE) AS price,
         {_SEED_COLUMNS} FROM found JOIN nation ON n_nationkey = ordinal % 25),
typed AS (SELECT *, CASE WHEN {feeds.class_sql('title')} = 'collab' THEN 'collab' ELSE seed_type END AS release_type FROM titled)
SELECT sku, CAST(seed_retail AS DOUBLE) AS retail_price, release_type,
       coalesce(nullif(seed_brand, ''), nullif(brand, ''), '') AS brand,
       coalesce(nullif(seed_model, ''), nullif(model, ''), '') AS model, title AS colorway,
       coalesce(seed_model, '') AS silhouette, coalesce({round_sql('price', 2)}, 0) AS market,
       release_type IN ('collab', 'limited') AS review, query FROM typed""")
def candidate_rows_query(spark, folder):
    """New codes of the price feed as reference entries; a seed per nation."""
    found = new_candidates(feeds.prices(spark, folder), "sku", "ordinal", feeds.reference(spark, folder), "sku")
    seeds = T.table(spark, folder, "nation").selectExpr("n_nationkey", *(f"{e} AS {c}" for c, e in _SEEDS.items()))
    rows = found.join(seeds, F.col("ordinal") % 25 == F.col("n_nationkey"))
    rows = rows.withColumns({"title": F.expr(_FOUND_TITLE), "secondary_title": F.lit("")})
    return candidate_rows(rows)
