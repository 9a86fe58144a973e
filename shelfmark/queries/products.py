"""Vocabulary lookups and the processed tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.dedupe import first_per_key
from ..operators.guards import select_sites
from ..operators.lookup import first_resolved, resolve, resolve_arrays, unmatched
from ..plans import conform, statistics
from ..session import cut_lineage
from . import retail
from .registry import query, table
from .text import fold_sql, percent_sql


@query(f"""
WITH {retail.VOCABULARY_SQL}
SELECT p_partkey, t.canonical AS category, coalesce(t.canonical, b.canonical) AS known
FROM part LEFT JOIN categories_lookup t ON t.folded = {fold_sql('p_type')}
LEFT JOIN (SELECT folded, canonical FROM categories_lookup) b
  ON b.folded = {fold_sql("split_part(p_name, ' ', 1)")}
""")
def lookup_category(spark: SparkSession, folder: str) -> DataFrame:
    categories = retail.vocabularies(spark)["categories"]
    parts = table(spark, folder, "part").withColumn("word", F.split_part(
        "p_name", F.lit(" "), F.lit(1)))
    both = first_resolved(resolve(parts, category=("p_type", categories)), "known",
                          ["p_type", "word"], categories)
    return both.select("p_partkey", "category", "known")


@query(f"""
WITH {retail.VOCABULARY_SQL}, words AS (
  SELECT p_partkey, unnest(string_split(p_name, ' ') || [p_type, p_brand]) AS word FROM part),
found AS (
  SELECT p_partkey, min(canonical) AS low, max(canonical) AS high
  FROM words JOIN (SELECT * FROM categories_lookup UNION ALL SELECT * FROM brands_lookup) v
    ON v.folded = {fold_sql('word')} GROUP BY 1)
SELECT p_partkey, CASE WHEN low = high THEN low WHEN low < high THEN 'SEVERAL' END AS term
FROM part LEFT JOIN found USING (p_partkey)
""")
def resolve_word_arrays(spark: SparkSession, folder: str) -> DataFrame:
    known = retail.vocabularies(spark)
    terms = known["categories"].spellings(spark).unionByName(known["brands"].spellings(spark))
    parts = table(spark, folder, "part").select(
        "p_partkey", F.concat(F.split("p_name", " "), F.array("p_type", "p_brand")).alias("words"))
    return resolve_arrays(parts, ["p_partkey"], "words", "term", terms,
                          "SEVERAL").select("p_partkey", "term")


@query(f"""
WITH {retail.VOCABULARY_SQL}
SELECT p_brand AS value, count(*) AS products FROM part
WHERE p_brand IS NOT NULL AND {fold_sql('p_brand')} NOT IN (SELECT folded FROM brands_lookup)
GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 9
""")
def unmatched_report(spark: SparkSession, folder: str) -> DataFrame:
    # One more than the eight shown says whether there are more.
    brands = retail.vocabularies(spark)["brands"]
    return unmatched(table(spark, folder, "part"), "p_brand", brands).limit(9)


@query(f"""
WITH {retail.VOCABULARY_SQL}
SELECT regexp_replace(trim(text), '[ \\t\\n\\x0B\\f\\r]+', ' ', 'g') AS value,
  count(*) AS products
FROM conversations
WHERE {fold_sql('text')} NOT IN (SELECT folded FROM brands_lookup) AND trim(text) <> ''
GROUP BY 1
""")
def unmatched_texts(spark: SparkSession, folder: str) -> DataFrame:
    brands = retail.vocabularies(spark)["brands"]
    return unmatched(table(spark, folder, "conversations"), "text", brands)


@query(f"WITH {retail.STAGED_SQL} SELECT * FROM crawls")
def crawls_table(spark: SparkSession, folder: str) -> DataFrame:
    return conform.crawls(retail.staged_crawls(spark, folder),
                          retail.vocabularies(spark)["currencies"])


@query(f"WITH {retail.STAGED_SQL} SELECT * FROM retailers")
def retailers_table(spark: SparkSession, folder: str) -> DataFrame:
    return conform.retailers(retail.staged_crawls(spark, folder),
                             retail.vocabularies(spark)["countries"])


@query(f"WITH {retail.STAGED_SQL} SELECT * FROM dates")
def dates_table(spark: SparkSession, folder: str) -> DataFrame:
    return conform.dates(retail.staged_crawls(spark, folder))


def described(spark: SparkSession, folder: str) -> DataFrame:
    known = retail.vocabularies(spark)
    return conform.described_products(
        retail.staged_products(spark, folder), known["brands"], known["categories"],
        known["genders"])


def variants(spark: SparkSession, folder: str, products: DataFrame | None = None,
             carry: tuple[str, ...] = ()) -> DataFrame:
    currencies = conform.crawl_currencies(
        retail.staged_crawls(spark, folder), retail.vocabularies(spark)["currencies"])
    if products is None:
        products = cut_lineage(described(spark, folder))    # a table, read twice
    return conform.variants(retail.staged_variants(spark, folder), products, currencies,
                            carry=carry)


@query(f"WITH {retail.STAGED_SQL} SELECT * EXCLUDE (size_slot, color_slot) FROM products")
def allowlist_products(spark: SparkSession, folder: str) -> DataFrame:
    return conform.products(described(spark, folder))


@query(f"""
WITH {retail.STAGED_SQL}
SELECT *, {percent_sql('price', 'original_price')} AS discount FROM variants
""")
def variant_join(spark: SparkSession, folder: str) -> DataFrame:
    return variants(spark, folder)


@query(f"""
WITH {retail.STAGED_SQL}
SELECT brand, count(*) AS n_variants, count(original_price) AS on_sale,
  cast(round(avg({percent_sql('price', 'original_price')}::DOUBLE), 2) AS DECIMAL(12,2))
    AS mean_discount,
  cast(sum(price) AS DECIMAL(22,2)) AS total_price
FROM variants JOIN products USING (product, retailer, date) GROUP BY brand
""")
def discount_by_brand(spark: SparkSession, folder: str) -> DataFrame:
    """The flagship: from staged rows to the average discount of each allowlisted brand."""
    return (
        variants(spark, folder, carry=("brand",)).groupBy("brand")
        .agg(F.count(F.lit(1)).alias("n_variants"),
             F.count("original_price").alias("on_sale"),
             F.round(F.avg(F.col("discount").cast("double")), 2).cast("decimal(12,2)")
             .alias("mean_discount"),
             F.sum("price").alias("total_price"))
    )


@query("""
SELECT o_custkey, cast(o_orderdate AS DATE) AS date, o_orderkey, o_orderstatus, o_totalprice
FROM orders QUALIFY row_number() OVER (
  PARTITION BY o_custkey, cast(o_orderdate AS DATE)
  ORDER BY o_totalprice DESC, o_orderkey, o_orderstatus) = 1
""")
def best_per_group(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders").select(
        "o_custkey", F.to_date("o_orderdate").alias("date"), "o_orderkey", "o_orderstatus",
        "o_totalprice")
    return first_per_key(orders, ["o_custkey", "date"], [F.desc("o_totalprice")])


@query("""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice,
  cast(l_shipdate AS DATE) AS shipped
FROM lineitem QUALIFY row_number() OVER (
  PARTITION BY l_orderkey, l_linenumber
  ORDER BY l_partkey, l_suppkey, l_quantity, l_extendedprice, l_shipdate) = 1
""")
def dedupe_grain(spark: SparkSession, folder: str) -> DataFrame:
    lines = table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity",
        "l_extendedprice", F.to_date("l_shipdate").alias("shipped"))
    return first_per_key(lines, ["l_orderkey", "l_linenumber"], ["l_partkey", "l_suppkey"])


@query(f"""
WITH {retail.STAGED_SQL}, per AS (
  SELECT product, retailer, date, count(*) AS n, bool_or(available) AS any_in,
    bool_and(available) AS all_in FROM variants GROUP BY ALL)
SELECT count(*) AS products, sum(n)::BIGINT AS variants,
  count(*) FILTER (any_in AND NOT all_in) AS partly_in_stock,
  cast(round(count(*) FILTER (any_in AND NOT all_in) / count(*), 4) AS DECIMAL(5,4)) AS partly_share,
  cast(round(sum(n) / count(*), 2) AS DECIMAL(12,2)) AS variants_per_product
FROM per
""")
def partial_stock(spark: SparkSession, folder: str) -> DataFrame:
    return statistics.stock_summary(variants(spark, folder))


@query("""
SELECT s_suppkey, s_name AS name, s_acctbal > 0 AS enabled FROM supplier WHERE s_acctbal > 0
""")
def enabled_sites(spark: SparkSession, folder: str) -> DataFrame:
    sites = table(spark, folder, "supplier").select(
        "s_suppkey", F.col("s_name").alias("name"), (F.col("s_acctbal") > 0).alias("enabled"))
    return select_sites(sites)


@query("""
SELECT s_suppkey, s_name AS name, s_acctbal > 0 AS enabled FROM supplier
WHERE s_suppkey IN (SELECT min(s_suppkey) FROM supplier UNION ALL
                    SELECT max(s_suppkey) FROM supplier)
""")
def named_sites(spark: SparkSession, folder: str) -> DataFrame:
    """Sites asked for by name, whether enabled or not."""
    sites = table(spark, folder, "supplier").select(
        "s_suppkey", F.col("s_name").alias("name"), (F.col("s_acctbal") > 0).alias("enabled"))
    ends = sites.agg(F.min_by("name", "s_suppkey"), F.max_by("name", "s_suppkey")).first()
    return select_sites(sites, list(ends))
