"""Crawl-trace analytics with events as the trace.

Event types are the stores, days their listings, users the products a page delivers,
in the order of time: few stores, each with a large share of all deliveries.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import trace
from ..operators.ranking import beyond_largest, largest, largest_per_group
from ..operators.running import dense_position
from .registry import query, table

SITE = ["site"]
FIRST_DAY = "2024-01-01"

DELIVERED = """delivered AS (
  SELECT event_type AS site, cast(ts AS DATE) AS listing, user_id AS product_id, ts, event_id
  FROM events),
firsts AS (
  SELECT * FROM delivered QUALIFY row_number() OVER (
    PARTITION BY site, product_id ORDER BY ts, event_id) = 1),
yields AS (
  SELECT d.site, d.listing, d.delivered, coalesce(f.new_products, 0)::BIGINT AS new_products
  FROM (SELECT site, listing, count(*) AS delivered FROM delivered GROUP BY ALL) d
  LEFT JOIN (SELECT site, listing, count(*) AS new_products FROM firsts GROUP BY ALL) f
    ON f.site = d.site AND f.listing = d.listing)"""


def delivered(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "events").select(
        F.col("event_type").alias("site"), F.to_date("ts").alias("listing"),
        F.col("user_id").alias("product_id"), "ts", "event_id")


@query(f"WITH {DELIVERED} SELECT site, product_id, listing, event_id FROM firsts")
def first_delivery(spark: SparkSession, folder: str) -> DataFrame:
    return trace.first_deliveries(delivered(spark, folder), SITE, ["ts", "event_id"]).select(
        "site", "product_id", "listing", "event_id")


@query(f"WITH {DELIVERED} SELECT site, listing, delivered, new_products FROM yields")
def listing_yield(spark: SparkSession, folder: str) -> DataFrame:
    return trace.listing_yield(delivered(spark, folder), SITE, ["ts", "event_id"])


LISTED = f"""{DELIVERED},
listed AS (
  SELECT site, row_number() OVER (PARTITION BY site ORDER BY listing) - 1 AS ix, listing,
    new_products, cast(ceil(delivered / 10.0) AS BIGINT) AS pages_fetched FROM yields)"""


def listed(spark: SparkSession, folder: str) -> DataFrame:
    yields = trace.listing_yield(delivered(spark, folder), SITE, ["ts", "event_id"])
    numbered = yields.select(
        "site", "listing", "new_products",
        F.ceil(F.col("delivered") / 10).alias("pages_fetched"),
        F.datediff("listing", F.lit(FIRST_DAY).cast("date")).alias("day"))
    return dense_position(numbered, SITE, "day", "ix").drop("day")


@query(f"""
WITH {LISTED}, islands AS (
  SELECT *, ix >= 3 AS tail, ix >= 3 AND new_products < 25 AS barren,
    sum(CASE WHEN ix >= 3 AND new_products < 25 THEN 0 ELSE 1 END)
      OVER (PARTITION BY site ORDER BY ix) AS island FROM listed),
streaks AS (
  SELECT *, sum(barren::INTEGER) OVER (PARTITION BY site, island ORDER BY ix) AS streak
  FROM islands),
ends AS (SELECT site, min(ix) AS stop FROM streaks WHERE streak >= 5 GROUP BY site)
SELECT site, ix, listing, new_products, pages_fetched, tail,
  stop IS NULL OR ix <= stop AS walked FROM islands LEFT JOIN ends USING (site)
""")
def barren_tail(spark: SparkSession, folder: str) -> DataFrame:
    return trace.tail_cutoff(listed(spark, folder), SITE, guaranteed=3, page_budget=None)


@query(f"""
WITH {LISTED}, spent AS (
  SELECT *, coalesce(sum(pages_fetched) OVER (PARTITION BY site ORDER BY ix
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM listed),
ends AS (SELECT site, min(ix) AS stop FROM spent WHERE ix >= 2 AND before >= 100 GROUP BY site)
SELECT site, ix, listing, new_products, pages_fetched, ix >= 2 AS tail,
  stop IS NULL OR ix < stop AS walked FROM listed LEFT JOIN ends USING (site)
""")
def page_budget(spark: SparkSession, folder: str) -> DataFrame:
    return trace.tail_cutoff(listed(spark, folder), SITE, guaranteed=2, patience=None,
                             page_budget=100)


def _documents(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents").select(
        F.col("source").alias("site"), F.col("lang").alias("vendor"), "doc_id")


@query("""
SELECT source AS site, lang AS vendor, count(*) AS products FROM documents
WHERE lang IS NOT NULL AND lang <> '' GROUP BY ALL
""")
def vendor_tally(spark: SparkSession, folder: str) -> DataFrame:
    return trace.vendor_tally(_documents(spark, folder), SITE)


@query("""
SELECT source AS site, count(DISTINCT lang) AS vendors,
  CASE WHEN count(DISTINCT lang) > 3 THEN 'multi-brand' ELSE 'single-brand' END AS shape
FROM documents WHERE lang <> '' GROUP BY 1
""")
def brand_shape(spark: SparkSession, folder: str) -> DataFrame:
    return trace.brand_shape(_documents(spark, folder), SITE)


@query("""
WITH tally AS (SELECT source AS site, lang AS vendor, count(*) AS products
               FROM documents GROUP BY ALL)
SELECT *, row_number() OVER (PARTITION BY site ORDER BY products DESC, vendor)::INTEGER AS rank
FROM tally QUALIFY rank <= 2
""")
def vendor_preview(spark: SparkSession, folder: str) -> DataFrame:
    tally = trace.vendor_tally(_documents(spark, folder), SITE)
    return largest_per_group(tally, SITE, "products", "vendor", 2)


COLLECTIONS = """collections AS (
  SELECT regexp_extract(url, '^https?://([^/]+)', 1) AS handle,
    sum(CASE WHEN length(html) > 4000 THEN 1 ELSE 0 END)::BIGINT AS products_count,
    regexp_extract(url, '([a-z]+)/', 1) AS section
  FROM pages GROUP BY ALL)"""


def collections(spark: SparkSession, folder: str) -> DataFrame:
    return (
        table(spark, folder, "pages")
        .groupBy(F.regexp_extract("url", "^https?://([^/]+)", 1).alias("handle"),
                 F.regexp_extract("url", "([a-z]+)/", 1).alias("section"))
        .agg(F.count_if(F.length("html") > 4000).alias("products_count"))
    )


@query(f"""
WITH {COLLECTIONS} SELECT handle, section, products_count FROM collections
WHERE handle <> '' AND products_count > 0 ORDER BY products_count DESC, handle, section LIMIT 10
""")
def collection_topk(spark: SparkSession, folder: str) -> DataFrame:
    kept = trace.collections_worth_walking(collections(spark, folder))
    named = kept.withColumn("name", F.struct("handle", "section"))
    return largest(named, "products_count", "name", 10).drop("name")


@query("""
WITH sized AS (
  SELECT lang, source, count(*) AS products_count FROM documents GROUP BY ALL),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY products_count DESC, source) AS r
           FROM sized)
SELECT lang, greatest(count(*) - 5, 0) AS tail_rows,
  coalesce(sum(products_count) FILTER (r > 5), 0)::BIGINT AS tail_total
FROM ranked GROUP BY lang
""")
def collection_tail(spark: SparkSession, folder: str) -> DataFrame:
    sized = table(spark, folder, "documents").groupBy("lang", "source").agg(
        F.count(F.lit(1)).alias("products_count"))
    return beyond_largest(sized, ["lang"], "products_count", "source", 5)
