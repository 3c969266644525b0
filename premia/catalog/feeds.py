"""Market feeds made from the given tables, once as DataFrames and once as SQL.

Orders are the price feed: an order names its customer's number as a product code, written in a way that
depends on the order's priority, with the part of that number as the brand's source. Customers are the
release feed, parts the curated reference.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from premia.catalog import tables as T

_RAW_SKU = """CASE o_orderpriority
    WHEN '1-URGENT' THEN concat('pk ', o_custkey)
    WHEN '2-HIGH' THEN concat(' PK_', o_custkey, ' ')
    WHEN '3-MEDIUM' THEN concat('Pk.-_', o_custkey, '!')
    WHEN '4-NOT SPECIFIED' THEN concat('pk/', o_custkey)
    ELSE concat('Z', o_orderkey, '/pk', '-', o_custkey) END"""
_PRICE_BRAND = """CASE o_orderstatus WHEN 'F' THEN upper(p_brand) WHEN 'O' THEN concat(' ', p_brand)
    ELSE CASE WHEN p_type = 'PROMO' THEN 'Other' ELSE '' END END"""
_PRICE = """CASE WHEN o_totalprice < 20000 THEN '0' WHEN o_totalprice < 40000 THEN 'n/a'
    WHEN o_totalprice < 60000 THEN NULL ELSE CAST(o_totalprice / 100 AS {text}) END"""
_RELEASE_DATE = """CASE c_mktsegment WHEN 'MACHINERY' THEN '' WHEN 'HOUSEHOLD' THEN NULL
    ELSE concat(2000 + c_nationkey, '-03-10T23:59:59.999Z') END"""
_RELEASE_YEAR = "CASE c_mktsegment WHEN 'MACHINERY' THEN CAST(1990 + c_nationkey AS {text}) ELSE '' END"
_REFERENCE_DATE = "CASE p_type WHEN 'SMALL' THEN '2018-05-09' ELSE '' END"
_REFERENCE_TYPE = "CASE p_type WHEN 'PROMO' THEN 'limited' WHEN 'ECONOMY' THEN 'collab' ELSE '' END"


def prices(spark, folder):
    orders = T.table(spark, folder, "orders")
    parts = T.table(spark, folder, "part").select("p_partkey", "p_brand", "p_name", "p_type")
    rows = orders.join(parts, F.col("o_custkey") == F.col("p_partkey"), "left")
    return rows.selectExpr(
        "o_orderkey AS ordinal",
        "CAST(o_orderkey AS STRING) AS id",
        f"{_RAW_SKU} AS sku",
        f"{_PRICE_BRAND} AS brand",
        "CASE WHEN p_type = 'SMALL' THEN NULL ELSE p_name END AS model",
        "concat(p_name, ' x ', p_brand) AS title",
        "'' AS primary_title",
        f"{_PRICE.format(text='STRING')} AS avg_price",
        "CASE WHEN o_orderstatus = 'P' THEN NULL ELSE year(o_orderdate) END AS weekly_orders",
    )


def releases(spark, folder):
    return T.table(spark, folder, "customer").selectExpr(
        "c_custkey AS ordinal",
        "concat('PK ', c_custkey) AS sku",
        "c_mktsegment AS brand",
        "c_name AS model",
        "c_name AS name",
        "CASE WHEN c_nationkey > 12 THEN c_mktsegment END AS colorway",
        f"{_RELEASE_DATE} AS release_date",
        f"{_RELEASE_YEAR.format(text='STRING')} AS release_date_year",
    )


def reference(spark, folder):
    return T.table(spark, folder, "part").where("p_type <> 'STANDARD'").selectExpr(
        "p_partkey AS ordinal",
        "concat('PK-', p_partkey) AS sku",
        "p_retailprice AS retail_price",
        f"{_REFERENCE_TYPE} AS release_type",
        "p_brand AS brand",
        "CASE WHEN p_size > 25 THEN p_name ELSE '' END AS model",
        "'' AS colorway",
        "CAST(p_size AS STRING) AS silhouette",
        f"{_REFERENCE_DATE} AS release_date",
    )


def normalize_sql(raw: str) -> str:
    """The upper case of the sharp s is SS, which DuckDB's upper leaves out."""
    upper = f"upper(replace(coalesce({raw}, ''), 'ß', 'SS'))"
    kept = f"regexp_replace({upper}, '[^\\p{{L}}\\p{{N}} _/\\-]', '', 'g')"
    return f"trim(regexp_replace({kept}, '[ _/\\-]+', '-', 'g'), '-')"


def candidates_sql(source: str, key: str, raw: str) -> str:
    """(key, place, candidate) rows of a code's candidates."""
    return f"""
  SELECT {key}, 0 AS place, {normalize_sql(raw)} AS candidate FROM {source}
  UNION ALL
  SELECT {key}, place, {normalize_sql('piece')} AS candidate
  FROM (SELECT {key}, unnest(string_split({raw}, '/')) AS piece,
               generate_subscripts(string_split({raw}, '/'), 1) AS place FROM {source}) pieces"""


def crc32_sql(text: str) -> str:
    """CRC-32 of ASCII text, bit by bit."""
    step = "list_reduce([xor(crc, byte), 0, 0, 0, 0, 0, 0, 0, 0], lambda c, i: xor(c // 2, 3988292384 * (c % 2)))"
    codes = f"list_transform(string_split({text}, ''), lambda ch: CAST(ascii(ch) AS BIGINT))"
    return (
        f"(xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), {codes}), "
        f"lambda crc, byte: {step}), 4294967295) & 2147483647)"
    )


FEEDS_SQL = f"""
prices AS (
  SELECT o_orderkey AS ordinal, CAST(o_orderkey AS VARCHAR) AS id, {_RAW_SKU} AS sku,
         {_PRICE_BRAND} AS brand, CASE WHEN p_type = 'SMALL' THEN NULL ELSE p_name END AS model,
         p_name || ' x ' || p_brand AS title, '' AS primary_title,
         {_PRICE.format(text='VARCHAR')} AS avg_price,
         CASE WHEN o_orderstatus = 'P' THEN NULL ELSE year(o_orderdate) END AS weekly_orders
  FROM orders LEFT JOIN part ON o_custkey = p_partkey),
releases AS (
  SELECT c_custkey AS ordinal, concat('PK ', c_custkey) AS sku, c_mktsegment AS brand,
         c_name AS model, c_name AS name,
         CASE WHEN c_nationkey > 12 THEN c_mktsegment END AS colorway,
         {_RELEASE_DATE} AS release_date, {_RELEASE_YEAR.format(text='VARCHAR')} AS release_date_year
  FROM customer),
reference AS (
  SELECT p_partkey AS ordinal, concat('PK-', p_partkey) AS sku, p_retailprice AS retail_price,
         {_REFERENCE_TYPE} AS release_type, p_brand AS brand,
         CASE WHEN p_size > 25 THEN p_name ELSE '' END AS model, '' AS colorway,
         CAST(p_size AS VARCHAR) AS silhouette, {_REFERENCE_DATE} AS release_date
  FROM part WHERE p_type <> 'STANDARD')"""

MERGED_SQL = f"""{FEEDS_SQL},
anchors AS (
  SELECT *, {normalize_sql('sku')} AS normalized_sku FROM prices
  WHERE {normalize_sql('sku')} <> ''
  QUALIFY row_number() OVER (PARTITION BY {normalize_sql('sku')} ORDER BY ordinal) = 1),
release_by_code AS (
  SELECT *, {normalize_sql('sku')} AS code FROM releases WHERE {normalize_sql('sku')} <> ''
  QUALIFY row_number() OVER (PARTITION BY {normalize_sql('sku')} ORDER BY ordinal) = 1),
reference_by_code AS (
  SELECT *, {normalize_sql('sku')} AS code FROM reference WHERE {normalize_sql('sku')} <> ''
  QUALIFY row_number() OVER (PARTITION BY {normalize_sql('sku')} ORDER BY ordinal DESC) = 1),
tried AS ({candidates_sql('anchors', 'normalized_sku', 'sku')}),
release_match AS (
  SELECT normalized_sku, arg_min(code, place) AS code FROM tried JOIN release_by_code ON code = candidate
  WHERE candidate <> '' GROUP BY normalized_sku),
reference_match AS (
  SELECT normalized_sku, arg_min(code, place) AS code FROM tried JOIN reference_by_code ON code = candidate
  WHERE candidate <> '' GROUP BY normalized_sku),
merged AS (
  SELECT a.ordinal, a.sku, a.normalized_sku,
         coalesce(nullif(a.brand, ''), nullif(r.brand, ''), '') AS brand,
         coalesce(nullif(a.model, ''), nullif(r.model, ''), '') AS model,
         coalesce(nullif(r.colorway, ''), '') AS colorway,
         coalesce(nullif(a.title, ''), nullif(r.name, ''), '') AS title,
         coalesce(nullif(a.primary_title, ''), nullif(a.model, ''), '') AS silhouette,
         a.id AS product_id,
         CASE WHEN TRY_CAST(avg_price AS DOUBLE) > 0 THEN TRY_CAST(avg_price AS DOUBLE) END AS market_avg,
         coalesce(nullif(r.release_date, ''), nullif(r.release_date_year, '')) AS release_date,
         CAST(coalesce(weekly_orders, 0) AS BIGINT) AS weekly_orders
  FROM anchors a LEFT JOIN release_match m USING (normalized_sku)
  LEFT JOIN release_by_code r ON r.code = m.code)"""

JUDGED_SQL = f"""{MERGED_SQL},
judged AS (
  SELECT m.*, f.code AS ref_code, f.retail_price, f.release_type AS ref_type, f.brand AS ref_brand,
         f.model AS ref_model, f.colorway AS ref_colorway, f.silhouette AS ref_silhouette,
         coalesce(m.release_date, nullif(f.release_date, '')) AS release_text,
         CASE WHEN f.code IS NULL THEN 'no_retail'
              WHEN trim(m.brand) <> '' AND trim(f.brand) <> ''
                   AND lower(trim(m.brand)) <> lower(trim(f.brand)) THEN 'identity_mismatch'
              WHEN m.market_avg IS NULL THEN 'no_market'
              WHEN coalesce(m.release_date, nullif(f.release_date, '')) IS NULL THEN 'no_release_date'
         END AS excluded
  FROM merged m LEFT JOIN reference_match x USING (normalized_sku)
  LEFT JOIN reference_by_code f ON f.code = x.code)"""


def date_sql(text: str) -> str:
    """An ISO timestamp, date or bare year as UTC midnight."""
    return (
        f"CASE WHEN length({text}) = 4 THEN CAST({text} || '-01-01' AS TIMESTAMP) "
        f"ELSE CAST(CAST(substr({text}, 1, 10) AS DATE) AS TIMESTAMP) END"
    )


def class_sql(title: str) -> str:
    """Release class of a title."""
    from premia.functions.text import COLLAB_TOKENS, LIMITED_TOKENS

    def any_of(tokens):
        return " OR ".join(f"contains(' ' || lower({title}) || ' ', '{t}')" for t in tokens)

    return (
        f"CASE WHEN {any_of(COLLAB_TOKENS)} THEN 'collab' "
        f"WHEN {any_of(LIMITED_TOKENS)} THEN 'limited' ELSE 'general' END"
    )


LANDED_SQL = f"""{JUDGED_SQL},
landed AS (
  SELECT row_number() OVER (ORDER BY ordinal) AS row_id, ordinal, ref_code AS landed_sku,
         CAST({crc32_sql('ref_code')} AS BIGINT) AS shoe_id,
         coalesce(nullif(ref_brand, ''), brand) AS brand,
         coalesce(nullif(ref_model, ''), model) AS model,
         coalesce(nullif(ref_colorway, ''), colorway) AS colorway,
         retail_price, {date_sql('release_text')} AS release_date,
         coalesce(nullif(ref_type, ''), {class_sql('title')}) AS release_type,
         coalesce(nullif(ref_silhouette, ''), silhouette) AS silhouette,
         market_avg AS sale_price, product_id AS source_item_id, weekly_orders
  FROM judged WHERE excluded IS NULL)"""
