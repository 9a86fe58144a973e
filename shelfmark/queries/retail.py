"""The given tables read as a retail crawl.

Suppliers are the stores, parts their products, line items the variants a crawl saw; a
store is crawled twice on one day of every year it shipped in. The frames have the
shape of shredded documents, so the library's own table builders run on them.
``STAGED_SQL`` is the same in SQL.
"""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import vocabularies as voc
from ..sources.raw import Shredded
from .registry import spread_table, table
from .text import fold_sql, part_options

BRAND_NUMBERS = range(1, 16)
BRANDS = {
    f"Brand#{n}": {"segment": voc.SEGMENTS[n % len(voc.SEGMENTS)],
                   "tier": voc.TIERS[n % len(voc.TIERS)],
                   "aliases": [f"House {n}"]}
    for n in BRAND_NUMBERS
}
CATEGORIES = {
    "Everyday": {"aliases": ["Economy", "Promo"]},
    "Standard": {"aliases": ["Medium"]},
    "Large": {},
}


@lru_cache(maxsize=1)
def vocabularies(spark: SparkSession) -> dict[str, voc.Vocabulary]:
    return voc.load_vocabularies(spark, {"brands": BRANDS}, {"categories": CATEGORIES})


def _site(key: str) -> Column:
    return F.format_string("Supplier#%09d", F.col(key))


def staged_crawls(spark: SparkSession, folder: str) -> DataFrame:
    runs = (
        table(spark, folder, "lineitem")
        .groupBy("l_suppkey", F.year("l_shipdate").alias("y"),
                 (F.month("l_shipdate") > 6).alias("late"))
        .agg(F.count(F.lit(1)).alias("products_received"),
             F.countDistinct("l_partkey").alias("products_stored"),
             F.ceil(F.count(F.lit(1)) / 10).alias("pages"),
             F.count_if(F.col("l_quantity") < 5).alias("short_pages"),
             F.count_if(F.col("l_returnflag") == "A").alias("collections_crawled"))
    )
    stores = table(spark, folder, "supplier").select(
        F.col("s_suppkey").alias("l_suppkey"), "s_name", "s_nationkey")
    nation = F.col("s_nationkey")
    return runs.join(stores, "l_suppkey").select(
        F.lower("s_name").alias("site"),
        F.concat(F.lit("  https://"), F.lower("s_name"), F.lit(".example ")).alias("base_url"),
        F.element_at(F.array(*map(F.lit, ("usd", "Eur", "G.B.P", " SEK ", "CHF"))),
                     (nation % 5 + 1).cast("int")).alias("currency"),
        F.element_at(F.array(*map(F.lit, ("Italia", "U.S.A.", "Magyarország", "Atlantis"))),
                     (nation % 4 + 1).cast("int")).alias("country"),
        F.when(F.col("l_suppkey") % 7 == 0, F.concat(F.lit("House of "), "s_name"))
        .alias("brand_override"),
        _stamp(F.col("y"), F.col("late")).alias("scraped_at"),
        "products_received", "products_stored", "pages", "short_pages",
        "collections_crawled")


def _stamp(year: Column, late: Column) -> Column:
    return F.concat(year.cast("string"), F.when(late, "-06-15T15:00:00Z")
                    .otherwise("-06-15T09:14:02Z"))


def staged_products(spark: SparkSession, folder: str) -> DataFrame:
    seen = table(spark, folder, "lineitem").select(
        F.col("l_partkey").alias("p_partkey"), "l_suppkey",
        F.year("l_shipdate").alias("y")).distinct()
    size = F.col("p_size") % 6
    said = (F.when(size == 0, F.array(F.lit("mens"))).when(size == 1, F.array(F.lit("Women's")))
            .when(size == 2, F.array(F.lit("male"), F.lit("Ladies")))
            .when(size == 3, F.array(F.lit("Boys"), F.lit("Girls")))
            .when(size == 4, F.array(F.lit("Gender: Women"))))
    parts = part_options(table(spark, folder, "part")).select(
        "p_partkey", F.col("p_partkey").cast("string").alias("id"),
        F.concat(F.lit(" "), F.replace("p_name", F.lit(" "), F.lit("   ")), F.lit(" "),
                 F.col("p_partkey").cast("string")).alias("title"),
        F.when(F.col("p_partkey") % 3 == 0, F.replace("p_brand", F.lit("Brand#"), F.lit("HOUSE-")))
        .otherwise(F.col("p_brand")).alias("vendor"),
        F.col("p_type").alias("product_type"), said.alias("tags"), "options")
    return seen.join(parts, "p_partkey").select(
        "id", "title", "vendor", "product_type", "tags", "options",
        F.lower(_site("l_suppkey")).alias("site"),
        _stamp(F.col("y"), F.lit(False)).alias("scraped_at"))


def staged_variants(spark: SparkSession, folder: str) -> DataFrame:
    price = F.col("l_extendedprice").cast("decimal(12,2)")
    kind = F.col("l_partkey") % 4
    text = (F.when(F.col("l_linenumber") == 7, "on request")
            .when(F.col("l_quantity") == 1, "0.00").otherwise(price.cast("string")))
    compare_at = (F.when(kind == 0, (price * 20).cast("decimal(12,2)").cast("string"))
                  .when(kind == 1, (price + 250).cast("decimal(12,2)").cast("string"))
                  .when(kind == 2, (price * 21).cast("decimal(12,2)").cast("string")))
    return spread_table(spark, folder, "lineitem", "l_orderkey", "l_linenumber").select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("id"),
        F.when(F.col("l_linenumber") == 3, "  ").otherwise(
            F.concat_ws("  ", "l_returnflag", "l_orderkey")).alias("sku"),
        F.concat(F.lit(" size "), F.lower("l_returnflag")).alias("option1"),
        F.concat(F.lit("tone "), F.lower("l_linestatus")).alias("option2"),
        F.lit(None).cast("string").alias("option3"),
        text.alias("price"), compare_at.alias("compare_at_price"),
        (F.col("l_linestatus") == "O").alias("available"),
        F.col("l_partkey").cast("string").alias("product_id"),
        F.lower(_site("l_suppkey")).alias("site"),
        _stamp(F.year("l_shipdate"), F.lit(False)).alias("scraped_at"))


def staged(spark: SparkSession, folder: str) -> Shredded:
    return Shredded(staged_crawls(spark, folder), staged_products(spark, folder),
                    staged_variants(spark, folder))


# ── the same in SQL ──────────────────────────────────────────────────────────

def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def spellings_sql(definition) -> str:
    """VALUES of (spelling, canonical), canonical spellings included."""
    items = definition.items() if isinstance(definition, dict) else ((d, {}) for d in definition)
    pairs = [(s, c.upper()) for c, body in items for s in (c, *(body.get("aliases") or []))]
    return ", ".join(f"({_quoted(s)}, {_quoted(c)})" for s, c in pairs)


def vocabulary_sql(name: str, definition) -> str:
    return f"""{name}_lookup AS (
  SELECT DISTINCT {fold_sql('spelling')} AS folded, canonical
  FROM (VALUES {spellings_sql(definition)}) v(spelling, canonical))"""


VOCABULARY_SQL = ",\n".join(vocabulary_sql(n, d) for n, d in (
    ("brands", BRANDS), ("categories", CATEGORIES), ("genders", voc.GENDERS),
    ("countries", voc.COUNTRIES), ("currencies", voc.CURRENCIES)))

STAGED_SQL = f"""{VOCABULARY_SQL},
crawl_runs AS (
  SELECT l_suppkey, year(l_shipdate) AS y, month(l_shipdate) > 6 AS late,
    count(*) AS products_received, count(DISTINCT l_partkey) AS products_stored,
    cast(ceil(count(*) / 10.0) AS BIGINT) AS pages,
    count(*) FILTER (l_quantity < 5) AS short_pages,
    count(*) FILTER (l_returnflag = 'A') AS collections_crawled
  FROM lineitem GROUP BY ALL),
crawls_all AS (
  SELECT upper(s_name) AS site, 'https://' || lower(s_name) || '.example' AS base_url,
    ['USD', 'EUR', 'GBP', 'SEK', NULL][s_nationkey % 5 + 1] AS currency,
    ['IT', 'US', 'HU', NULL][s_nationkey % 4 + 1] AS country,
    CASE WHEN l_suppkey % 7 = 0 THEN upper('House of ' || s_name) END AS name,
    make_date(y, 6, 15) AS date, products_received, products_stored, pages, short_pages,
    collections_crawled
  FROM crawl_runs JOIN supplier ON s_suppkey = l_suppkey),
crawls AS (
  SELECT site, base_url, currency, name, date, products_received::INTEGER AS products_received,
    products_stored::INTEGER AS products_stored, pages::INTEGER AS pages,
    short_pages::INTEGER AS short_pages, collections_crawled::INTEGER AS collections_crawled
  FROM crawls_all
  QUALIFY row_number() OVER (PARTITION BY site, date ORDER BY products_stored DESC, base_url,
    currency NULLS FIRST, name NULLS FIRST, products_received, pages, short_pages,
    collections_crawled) = 1),
retailers AS (
  SELECT site AS name, min(base_url) AS url, min(country) AS country FROM crawls_all GROUP BY 1),
dates AS (
  SELECT DISTINCT date, 15 AS day, week(date)::INTEGER AS week, 6 AS month, 2 AS quarter,
    'SUMMER' AS season, year(date)::INTEGER AS year FROM crawls_all),
described AS (
  SELECT DISTINCT p_partkey, l_suppkey, year(l_shipdate) AS y FROM lineitem
  JOIN part ON p_partkey = l_partkey),
products AS (
  SELECT cast(p.p_partkey AS VARCHAR) AS product,
    'SUPPLIER#' || lpad(cast(l_suppkey AS VARCHAR), 9, '0') AS retailer,
    p_name || ' ' || p.p_partkey AS name, b.canonical AS brand, c.canonical AS category,
    ['MEN', 'WOMEN', 'UNISEX', 'KIDS', NULL, NULL][p_size % 6 + 1] AS gender,
    replace(upper(p_name), ' ', ' / ') AS color, cast(NULL AS VARCHAR) AS material,
    make_date(y, 6, 15) AS date,
    CASE WHEN p.p_partkey % 5 = 0 THEN NULL WHEN p.p_partkey % 2 = 0 THEN 1 ELSE 2 END AS size_slot,
    CASE WHEN p.p_partkey % 2 = 0 THEN 2 ELSE 1 END AS color_slot
  FROM described d JOIN part p ON p.p_partkey = d.p_partkey
  JOIN brands_lookup b ON b.folded = {fold_sql('''CASE WHEN p.p_partkey % 3 = 0
    THEN replace(p_brand, 'Brand#', 'HOUSE-') ELSE p_brand END''')}
  LEFT JOIN categories_lookup c ON c.folded = {fold_sql('p_type')}),
sold AS (
  SELECT l_orderkey || '-' || l_linenumber AS variant, cast(l_partkey AS VARCHAR) AS product,
    'SUPPLIER#' || lpad(cast(l_suppkey AS VARCHAR), 9, '0') AS retailer,
    make_date(year(l_shipdate), 6, 15) AS date,
    CASE WHEN l_linenumber <> 3 THEN l_returnflag || ' ' || l_orderkey END AS sku,
    'SIZE ' || l_returnflag AS option1, 'TONE ' || l_linestatus AS option2,
    cast(l_extendedprice AS DECIMAL(12,2)) AS stated, l_partkey % 4 AS kind,
    CASE WHEN l_linenumber <> 7 AND l_quantity <> 1 THEN stated END AS price,
    cast(CASE kind WHEN 0 THEN stated * 20 WHEN 1 THEN stated + 250 WHEN 2 THEN stated * 21 END
      AS DECIMAL(12,2)) AS compare_at,
    l_linestatus = 'O' AS available
  FROM lineitem),
sold_once AS (
  SELECT * FROM sold QUALIFY row_number() OVER (
    PARTITION BY variant, product, retailer, date ORDER BY sku NULLS FIRST, option1, option2,
    price NULLS FIRST, compare_at NULLS FIRST, available) = 1),
variants AS (
  SELECT s.variant, s.product, s.retailer, s.date, s.sku,
    CASE p.size_slot WHEN 1 THEN option1 WHEN 2 THEN option2 END AS size,
    CASE p.color_slot WHEN 1 THEN option1 WHEN 2 THEN option2 END AS color,
    s.price, c.currency,
    CASE WHEN compare_at > price AND price * 20 >= compare_at THEN compare_at END
      AS original_price, s.available
  FROM sold_once s JOIN products p USING (product, retailer, date)
  LEFT JOIN (SELECT DISTINCT site AS retailer, date, currency FROM crawls_all) c
    USING (retailer, date))"""
