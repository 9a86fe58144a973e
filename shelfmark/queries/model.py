"""The star schema derived from the given tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..local import empty_frame
from ..operators.keys import BUCKETS, DIGEST_DIGITS
from ..operators.merge import values_of
from ..plans import conform, star
from ..quality import loaded
from ..schemas import ANALYTICAL
from ..session import cut_lineage, shared_folder
from ..sources.tables import APPEND, TableStore
from . import products as processed
from . import retail
from .registry import query, table
from .text import percent_sql


def _digest(*columns: str) -> str:
    text = " || '|' || ".join(f"cast({c} AS VARCHAR)" for c in columns)
    return f"substr(md5({text}), 1, {DIGEST_DIGITS})"


def dense_sql(source: str, key: str, natural: str, start: str = "0") -> str:
    """``source`` numbered the way dense keys are: by digest, then by the key itself."""
    return (f"SELECT ({start} + row_number() OVER (ORDER BY {_digest(natural)}, {natural}))"
            f"::BIGINT AS {key}, * FROM {source}")


def insert_sql(held: str, rows: str, key: str, natural: str) -> str:
    """A dimension loaded from ``held``, then from ``rows``."""
    return f"""
first_{key} AS ({dense_sql(f'({held})', key, natural)}),
second_{key} AS ({dense_sql(
    f'(SELECT * FROM ({rows}) r WHERE r.{natural} NOT IN (SELECT {natural} FROM first_{key}))',
    key, natural, f'(SELECT coalesce(max({key}), 0) FROM first_{key})')}),
whole_{key} AS (SELECT * FROM first_{key} UNION ALL SELECT * FROM second_{key})"""


def _empty(spark: SparkSession, name: str) -> DataFrame:
    return empty_frame(spark, ANALYTICAL[name])


def _none(spark: SparkSession) -> dict[str, DataFrame]:
    return {name: _empty(spark, name) for name in star.DIMENSIONS}


SEGMENTS_SQL = insert_sql(
    "SELECT DISTINCT c_mktsegment AS name FROM customer WHERE c_mktsegment < 'G'",
    "SELECT DISTINCT c_mktsegment AS name FROM customer", "segment_key", "name")


@query(f"WITH {SEGMENTS_SQL} SELECT * FROM whole_segment_key")
def dim_simple(spark: SparkSession, folder: str) -> DataFrame:
    """Loaded twice: the segments of the first load keep their keys."""
    names = table(spark, folder, "customer").select(F.col("c_mktsegment").alias("name"))
    first = star.dimensions(_none(spark), {"segments": names.where("name < 'G'")})
    return star.dimensions(first, {"segments": names})["dim_segment"]


@query(f"""WITH {insert_sql(
    "SELECT n_name AS code, 'REGION ' || n_regionkey AS name FROM nation WHERE n_regionkey < 2",
    "SELECT n_name AS code, r_name AS name FROM nation JOIN region ON r_regionkey = n_regionkey",
    "country_key", "code")}
SELECT * FROM whole_country_key""")
def dim_country(spark: SparkSession, folder: str) -> DataFrame:
    """A held country keeps its first name."""
    nations = table(spark, folder, "nation")
    early = nations.where("n_regionkey < 2").select(
        F.col("n_name").alias("code"), F.concat(F.lit("REGION "), "n_regionkey").alias("name"))
    regions = table(spark, folder, "region").withColumnRenamed("r_regionkey", "n_regionkey")
    late = nations.join(regions, "n_regionkey").select(
        F.col("n_name").alias("code"), F.col("r_name").alias("name"))
    first = star.dimensions(_none(spark), {"countries": early})
    return star.dimensions(first, {"countries": late})["dim_country"]


@query(f"""
WITH {insert_sql("SELECT DISTINCT p_type AS name FROM part", "SELECT 'x' AS name WHERE false",
                 "segment_key", "name")},
{insert_sql("SELECT DISTINCT split_part(p_name, ' ', 1) AS name FROM part",
            "SELECT 'x' AS name WHERE false", "tier_key", "name")},
early AS (SELECT p_brand AS name, min(p_type) AS segment, min(split_part(p_name, ' ', 1)) AS tier
          FROM part WHERE p_size <= 2 GROUP BY 1),
late AS (SELECT p_brand AS name, max(p_type) AS segment,
           CASE WHEN max(p_size) > 49 THEN NULL ELSE max(split_part(p_name, ' ', 1)) END AS tier
         FROM part WHERE p_size > 1 GROUP BY 1),
{insert_sql("SELECT name FROM early", "SELECT name FROM late", "brand_key", "name")}
SELECT k.brand_key, k.name,
  CASE WHEN l.name IS NULL THEN es.segment_key ELSE ls.segment_key END AS segment_key,
  CASE WHEN l.name IS NULL THEN et.tier_key ELSE lt.tier_key END AS tier_key
FROM whole_brand_key k
LEFT JOIN early e ON e.name = k.name LEFT JOIN late l ON l.name = k.name
LEFT JOIN whole_segment_key es ON es.name = e.segment
LEFT JOIN whole_segment_key ls ON ls.name = l.segment
LEFT JOIN whole_tier_key et ON et.name = e.tier LEFT JOIN whole_tier_key lt ON lt.name = l.tier
""")
def dim_brand_type1(spark: SparkSession, folder: str) -> DataFrame:
    """The second load moves brands to other segments and tiers under the same key."""
    parts = table(spark, folder, "part").select(
        F.col("p_brand").alias("name"), F.col("p_type").alias("segment"), "p_size",
        F.split_part("p_name", F.lit(" "), F.lit(1)).alias("tier"))
    early = parts.where("p_size <= 2").groupBy("name").agg(
        F.min("segment").alias("segment"), F.min("tier").alias("tier"))
    late = parts.where("p_size > 1").groupBy("name").agg(
        F.max("segment").alias("segment"),
        F.when(F.max("p_size") <= 49, F.max("tier")).alias("tier"))
    held = star.dimensions(_none(spark), {
        "segments": parts.select(F.col("segment").alias("name")),
        "tiers": parts.select(F.col("tier").alias("name")), "brands": early})
    return star.dimensions(held, {"brands": late})["dim_brand"]


@query(f"""
WITH {insert_sql("SELECT n_name AS code, n_name AS name FROM nation",
                 "SELECT 'x' AS code, 'x' AS name WHERE false", "country_key", "code")},
{insert_sql("SELECT s_name AS name FROM supplier WHERE s_acctbal > 0",
            "SELECT s_name AS name FROM supplier", "retailer_key", "name")}
SELECT k.retailer_key, k.name, lower(k.name) || '/new' AS url, c.country_key
FROM whole_retailer_key k JOIN supplier s ON s.s_name = k.name
LEFT JOIN nation n ON n.n_nationkey = s.s_nationkey AND s.s_acctbal < 9000
LEFT JOIN whole_country_key c ON c.code = n.n_name
""")
def dim_retailer_type1(spark: SparkSession, folder: str) -> DataFrame:
    """A load that changes every address and takes some countries away."""
    nations = table(spark, folder, "nation").select(
        F.col("n_nationkey").alias("s_nationkey"), F.col("n_name").alias("country"))
    countries = nations.select(F.col("country").alias("code"), F.col("country").alias("name"))
    stores = table(spark, folder, "supplier").join(nations, "s_nationkey").select(
        F.col("s_name").alias("name"), F.lower("s_name").alias("url"), "country", "s_acctbal")
    held = star.dimensions(_none(spark), {
        "retailers": stores.where("s_acctbal > 0"), "countries": countries})
    late = stores.withColumn("url", F.concat("url", F.lit("/new"))).withColumn(
        "country", F.when(F.col("s_acctbal") < 9000, F.col("country")))
    return star.dimensions(held, {"retailers": late})["dim_retailer"]


DAYS_SQL = """SELECT DISTINCT cast(o_orderdate AS DATE) AS date,
  day(o_orderdate)::INTEGER AS day, week(o_orderdate)::INTEGER AS week,
  month(o_orderdate)::INTEGER AS month, quarter(o_orderdate)::INTEGER AS quarter,
  ['WINTER', 'SPRING', 'SUMMER', 'AUTUMN'][(month(o_orderdate) % 12) // 3 + 1] AS season,
  year(o_orderdate)::INTEGER AS year FROM orders"""


@query(f"""WITH {insert_sql(
    DAYS_SQL + " WHERE o_orderdate < DATE '1998-01-01'", DAYS_SQL, "date_key", "date")}
SELECT * FROM whole_date_key""")
def dim_date(spark: SparkSession, folder: str) -> DataFrame:
    staged = table(spark, folder, "orders").select(
        F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("scraped_at"))
    dates = conform.dates(staged)
    first = star.dimensions(_none(spark), {"dates": dates.where("date < date'1998-01-01'")})
    return star.dimensions(first, {"dates": dates})["dim_date"]


def _one_load(rows: str, key: str, natural: str) -> str:
    return f"dim_{key} AS ({dense_sql(f'({rows})', key, natural)})"


MODEL_SQL = ",\n".join([
    retail.STAGED_SQL,
    _one_load("SELECT DISTINCT canonical AS name FROM brands_lookup", "brand_key", "name"),
    _one_load("SELECT DISTINCT canonical AS name FROM categories_lookup", "category_key", "name"),
    _one_load("SELECT DISTINCT canonical AS name FROM genders_lookup", "gender_key", "name"),
    _one_load("SELECT DISTINCT canonical AS name FROM currencies_lookup", "currency_key", "name"),
    _one_load("SELECT name FROM retailers", "retailer_key", "name"),
    _one_load("SELECT date FROM dates", "date_key", "date"),
    """observed AS (
  SELECT p.product AS product_id, p.name, b.brand_key, r.retailer_key, c.category_key,
    g.gender_key, p.color, p.material, d.date_key, p.date
  FROM products p LEFT JOIN dim_brand_key b ON b.name = p.brand
  LEFT JOIN dim_retailer_key r ON r.name = p.retailer
  LEFT JOIN dim_category_key c ON c.name = p.category
  LEFT JOIN dim_gender_key g ON g.name = p.gender
  LEFT JOIN dim_date_key d ON d.date = p.date)""",
])


def interleaved_sql(rows: str, start: str) -> str:
    digest = _digest("product_id", "retailer_key", "date_key")
    return f"""SELECT ({start} + (row_number() OVER (
    PARTITION BY {digest} ORDER BY product_id, retailer_key, date_key) - 1) * {BUCKETS}
    + ('0x' || {digest})::BIGINT + 1)::BIGINT AS product_key, * FROM {rows}"""


def _dimensions(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    known = retail.vocabularies(spark)
    # A table, read twice below; what the crawls counted is no dimension's.
    crawls = cut_lineage(retail.staged_crawls(spark, folder).select(
        "site", "base_url", "country", "scraped_at"))
    return star.dimensions(_none(spark), {
        name: vocabulary.table(spark) for name, vocabulary in known.items()} | {
        "retailers": conform.retailers(crawls, known["countries"]),
        "dates": conform.dates(crawls)})


def _observed(spark: SparkSession, folder: str, dims: dict[str, DataFrame],
              rows: DataFrame) -> DataFrame:
    return star.product_observations(rows, dims["dim_brand"], dims["dim_retailer"],
                                     dims["dim_category"], dims["dim_gender"], dims["dim_date"])


@query(f"""
WITH {MODEL_SQL},
early AS ({interleaved_sql("(SELECT * EXCLUDE (date) FROM observed WHERE date < DATE '1998-01-01')", "0")}),
late AS ({interleaved_sql(
    "(SELECT * EXCLUDE (date) FROM observed WHERE date >= DATE '1998-01-01')",
    "(SELECT max(product_key) FROM early)")})
SELECT * FROM early UNION ALL SELECT * FROM late
""")
def dim_product_snapshot(spark: SparkSession, folder: str) -> DataFrame:
    """The crawls before 1998, then all of them: only the later ones are added."""
    dims = _dimensions(spark, folder)
    rows = cut_lineage(conform.products(processed.described(spark, folder)))   # read twice
    store = TableStore(spark, f"{shared_folder(spark)}/products-{uuid.uuid4().hex}")
    load = store.begin()
    load.write("dim_product", star.new_products(_empty(spark, "dim_product"), _observed(
        spark, folder, dims, rows.where("date < date'1998-01-01'"))), APPEND,
        partition_by="date_key")
    load.commit()
    held = store.read("dim_product")
    added = star.new_products(held, _observed(spark, folder, dims, rows),
                              highest=store.highest("dim_product", "product_key"))
    return held.select(*added.columns).unionByName(added)


FACT_SQL = f"""{MODEL_SQL},
dim_product AS ({interleaved_sql("observed", "0")}),
facts AS (
  SELECT v.product AS product_id, v.variant AS variant_id, p.product_key, p.brand_key,
    r.retailer_key, p.category_key, d.date_key, v.sku, v.size, v.color, v.price,
    v.original_price, cu.currency_key,
    {percent_sql('v.price', 'v.original_price')} AS discount, v.available
  FROM variants v JOIN dim_retailer_key r ON r.name = v.retailer
  JOIN dim_date_key d ON d.date = v.date
  JOIN dim_product p ON p.product_id = v.product AND p.retailer_key = r.retailer_key
    AND p.date_key = d.date_key
  LEFT JOIN dim_currency_key cu ON cu.name = v.currency)"""


def facts(spark: SparkSession, folder: str) -> DataFrame:
    dims = _dimensions(spark, folder)
    described = cut_lineage(processed.described(spark, folder))  # read twice, as a table is
    observed = _observed(spark, folder, dims, conform.products(described))
    snapshot = star.new_products(_empty(spark, "dim_product"), observed)
    # Written, the shuffles behind the variants are gone before those of the fact begin.
    variants = cut_lineage(processed.variants(spark, folder, described))
    rows = star.fact_rows(variants, snapshot, dims["dim_retailer"], dims["dim_date"],
                          dims["dim_currency"])
    return star.new_facts(_empty(spark, "fact_product_observation"), rows)


@query(f"WITH {FACT_SQL} SELECT * FROM facts")
def fact_observation(spark: SparkSession, folder: str) -> DataFrame:
    return facts(spark, folder)


@query(f"""
WITH {FACT_SQL},
held AS (SELECT * FROM facts WHERE date_key <= 4 AND available),
run AS (SELECT * REPLACE (original_price AS price) FROM facts WHERE date_key > 2)
SELECT * FROM held UNION ALL SELECT * FROM run r WHERE NOT EXISTS (
  SELECT 1 FROM held h WHERE h.variant_id = r.variant_id AND h.product_id = r.product_id
    AND h.retailer_key = r.retailer_key AND h.date_key = r.date_key)
""")
def fact_second_load(spark: SparkSession, folder: str) -> DataFrame:
    """A later load that overlaps the first with other prices: the first write stays."""
    rows = cut_lineage(facts(spark, folder))    # the held table and the run, each read back
    held = rows.where("date_key <= 4 AND available")
    run = rows.where("date_key > 2").withColumn("price", F.col("original_price"))
    return held.unionByName(star.new_facts(held, run, held_keys=values_of(held, "date_key")))


@query(f"""
WITH {FACT_SQL}, one AS (
  SELECT count(*) AS n, count(brand_key) AS b, count(category_key) AS c, count(currency_key) AS u
  FROM facts)
SELECT 'brand_key' AS "column", n AS n_rows, b AS filled,
  cast(round(b / n, 4) AS DECIMAL(5,4)) AS coverage FROM one
UNION ALL SELECT 'category_key', n, c, cast(round(c / n, 4) AS DECIMAL(5,4)) FROM one
UNION ALL SELECT 'currency_key', n, u, cast(round(u / n, 4) AS DECIMAL(5,4)) FROM one
""")
def fact_coverage(spark: SparkSession, folder: str) -> DataFrame:
    return loaded.fact_coverage(facts(spark, folder))
