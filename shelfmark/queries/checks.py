"""Data-quality checks over the given tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.dedupe import first_per_key
from ..operators.reconcile import set_difference
from ..plans import conform
from ..quality import findings, loaded, processed
from ..schemas import COUNT, GRAIN, NAME, NUMBER, OPTIONAL, PROCESSED, TEXT, Table, column
from ..session import shared_folder
from ..sources.tables import TableStore
from . import products as conformed
from . import retail
from .registry import query, table
from .text import PRICED, name_sql, priced_lines

NO_SAMPLE = "cast(NULL AS VARCHAR) AS sample"


def counted_sql(level: str, where: str, check: str, n: str, source: str,
                sample: str = NO_SAMPLE) -> str:
    return (f"SELECT '{level}' AS level, '{where}' AS \"where\", '{check}' AS \"check\", "
            f"n::BIGINT AS n, sample FROM (SELECT {n} AS n, {sample} FROM {source}) WHERE n > 0")


def union_sql(*parts: str) -> str:
    return "\nUNION ALL ".join(parts)


LABELLED = """labelled AS (
  SELECT d.doc_id, d.lang, d.source, l.quality, l.toxic,
    CASE WHEN d.n_chars < 0 THEN 'x' END AS remark
  FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id)"""
LABELS = [column("doc_id", COUNT, GRAIN), column("quality", NUMBER), column("toxic", NUMBER)]
LABELLED_SPEC = Table.of(*LABELS, column("lang", TEXT, NAME, OPTIONAL),
                         column("source", TEXT, NAME, OPTIONAL), column("remark", TEXT, OPTIONAL))


def labelled(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents").join(
        table(spark, folder, "labels"), "doc_id", "left").select(
        "doc_id", "lang", "source", "quality", "toxic",
        F.when(F.col("n_chars") < 0, "x").alias("remark"))


LABELLED_NULLS = [
    counted_sql("ERROR", "labelled", f"{c} is null", f"count(*) - count({c})", "labelled")
    for c in ("doc_id", "quality", "toxic")]
LABELLED_CASE = [
    counted_sql("ERROR", "labelled", f"{c} is not upper case", "count(*)",
                f"labelled WHERE {c} <> upper({c})", f"min({c}) AS sample")
    for c in ("lang", "source")]
LABELLED_EMPTY = counted_sql(
    "WARN", "labelled", "remark is null in every row",
    "CASE WHEN count(remark) = 0 THEN count(*) ELSE 0 END", "labelled")


@query(f"WITH {LABELLED} {union_sql(*LABELLED_NULLS, *LABELLED_CASE, LABELLED_EMPTY)}")
def qc_columns(spark: SparkSession, folder: str) -> DataFrame:
    """Nulls, case and empty columns of one table, in one pass."""
    return processed.column_checks(labelled(spark, folder), "labelled", LABELLED_SPEC)


@query(f"WITH {LABELLED} {union_sql(*LABELLED_NULLS)}")
def qc_nulls(spark: SparkSession, folder: str) -> DataFrame:
    frame = labelled(spark, folder).select("doc_id", "quality", "toxic")
    return processed.column_checks(frame, "labelled", Table.of(*LABELS))


@query(f"""
WITH {LABELLED}
SELECT 'ERROR' AS level, 'labelled' AS "where", c || ' is missing' AS "check", 1::BIGINT AS n,
  NULL::VARCHAR AS sample FROM (VALUES ('toxic'), ('quality')) v(c)
UNION ALL SELECT 'ERROR', 'none', 'no rows', 1, NULL FROM (SELECT count(*) AS n FROM labelled
  WHERE doc_id < 0) WHERE n = 0
""")
def qc_missing_columns(spark: SparkSession, folder: str) -> DataFrame:
    """A table without columns it has to have, and one without rows."""
    whole = labelled(spark, folder)
    lacking = processed.table_checks(whole.drop("quality", "toxic"), "labelled", LABELLED_SPEC)
    none = processed.table_checks(whole.where("doc_id < 0"), "none", LABELLED_SPEC)
    return lacking.unionByName(none.where("level = 'ERROR'"))


PARTS_UPPER = ("p_brand", "p_type", "p_name")


@query(union_sql(*(
    counted_sql("ERROR", "part", f"{c} is not upper case", "count(*)",
                f"part WHERE {c} <> upper({c})", f"min({c}) AS sample") for c in PARTS_UPPER)))
def qc_upper(spark: SparkSession, folder: str) -> DataFrame:
    spec = Table.of(*(column(c, TEXT, NAME) for c in PARTS_UPPER))
    return processed.column_checks(table(spark, folder, "part").select(*PARTS_UPPER), "part", spec)


@query(union_sql(
    counted_sql("ERROR", "lineitem", "duplicate on (l_orderkey, l_linenumber)",
                "count(*) - count(DISTINCT (l_orderkey, l_linenumber))", "lineitem"),
    counted_sql("ERROR", "orders", "duplicate on (o_orderkey)",
                "count(*) - count(DISTINCT o_orderkey)", "orders")))
def qc_grain(spark: SparkSession, folder: str) -> DataFrame:
    lines = processed.grain_check(table(spark, folder, "lineitem"), "lineitem",
                                  ["l_orderkey", "l_linenumber"])
    return lines.unionByName(processed.grain_check(table(spark, folder, "orders"), "orders",
                                                   ["o_orderkey"]))


@query(f"""
WITH {retail.VOCABULARY_SQL}, v AS (SELECT DISTINCT {name_sql('p_brand')} AS value FROM part),
t AS (SELECT DISTINCT {name_sql('p_type')} AS value FROM part)
{union_sql(
    counted_sql("ERROR", "part", "p_brand not in brands", "count(*)",
                "v WHERE value NOT IN (SELECT canonical FROM brands_lookup)",
                "min(value) AS sample"),
    counted_sql("ERROR", "part", "p_type not in categories", "count(*)",
                "t WHERE value NOT IN (SELECT canonical FROM categories_lookup)",
                "min(value) AS sample"))}
""")
def qc_vocab(spark: SparkSession, folder: str) -> DataFrame:
    known = retail.vocabularies(spark)
    parts = table(spark, folder, "part").select(F.upper("p_brand").alias("p_brand"),
                                                F.upper("p_type").alias("p_type"))
    return findings.together(
        processed.vocabulary_check(parts, "part", column, known[name].table(spark), "name", name)
        for column, name in (("p_brand", "brands"), ("p_type", "categories")))


@query(union_sql(
    counted_sql("ERROR", "lineitem", "not in orders", "count(DISTINCT l_orderkey)",
                """lineitem WHERE l_orderkey NOT IN (
                     SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'P')"""),
    counted_sql("ERROR", "labels", "not in documents", "count(DISTINCT doc_id)",
                "labels WHERE doc_id NOT IN (SELECT doc_id FROM documents)")))
def qc_orphans(spark: SparkSession, folder: str) -> DataFrame:
    lines = table(spark, folder, "lineitem").withColumnRenamed("l_orderkey", "o_orderkey")
    settled = table(spark, folder, "orders").where("o_orderstatus <> 'P'")
    orphans = processed.orphan_check(lines, "lineitem", settled, "orders", ["o_orderkey"])
    return orphans.unionByName(processed.orphan_check(
        table(spark, folder, "labels"), "labels", table(spark, folder, "documents"),
        "documents", ["doc_id"]))


MONEY_ROWS = f"""{PRICED}, money AS (
  SELECT CASE l_linenumber WHEN 1 THEN NULL WHEN 2 THEN price - 1000 ELSE price END AS price,
    CASE WHEN l_partkey % 4 < 3 THEN compare_at END AS original_price,
    CASE WHEN l_partkey % 4 = 0 THEN NULL WHEN l_partkey % 4 < 3
      THEN (compare_at - price) / 1000 END AS discount FROM priced)"""


@query(f"WITH {MONEY_ROWS} " + union_sql(*(
    counted_sql("ERROR", "variants", check, "count(*)", f"money WHERE {rule}")
    for check, rule in (
        ("price at or below zero", "price <= 0"),
        ("original_price not above price", "original_price <= price"),
        ("original_price without price", "original_price IS NOT NULL AND price IS NULL"),
        ("discount and original_price disagree",
         "(discount IS NULL) <> (original_price IS NULL)"),
        ("discount outside 0-95", "discount < 0 OR discount > 95")))))
def qc_money(spark: SparkSession, folder: str) -> DataFrame:
    lines = priced_lines(table(spark, folder, "lineitem"))
    kind = F.col("l_partkey") % 4
    price, compare_at = F.col("price"), F.col("compare_at")
    return processed.money_checks(lines.select(
        F.when(F.col("l_linenumber") == 1, None).when(F.col("l_linenumber") == 2, price - 1000)
        .otherwise(price).alias("price"),
        F.when(kind < 3, compare_at).alias("original_price"),
        F.when(kind.isin(1, 2), (compare_at - price) / 1000).alias("discount")))


@query("""
WITH staged AS (SELECT DISTINCT upper(c_name) AS site FROM customer),
processed AS (
  SELECT DISTINCT upper(c_name) AS site FROM orders JOIN customer ON c_custkey = o_custkey
  UNION SELECT upper(s_name) FROM supplier)
SELECT 'ERROR' AS level, 'coverage' AS "where", 'staged site missing from crawls' AS "check",
  n, sample FROM (SELECT count(*) AS n, min(site) AS sample FROM staged
                  WHERE site NOT IN (SELECT site FROM processed)) WHERE n > 0
UNION ALL SELECT 'WARN', 'coverage', 'site in crawls, nothing staged', n, sample
FROM (SELECT count(*) AS n, min(site) AS sample FROM processed
      WHERE site NOT IN (SELECT site FROM staged)) WHERE n > 0
""")
def qc_coverage(spark: SparkSession, folder: str) -> DataFrame:
    customers = table(spark, folder, "customer")
    ordering = customers.join(table(spark, folder, "orders"),
                              F.col("c_custkey") == F.col("o_custkey"), "left_semi")
    crawled = ordering.select(F.upper("c_name").alias("site")).unionByName(
        table(spark, folder, "supplier").select(F.upper("s_name").alias("site")))
    return processed.coverage_checks(customers.select(F.col("c_name").alias("site")), crawled)


@query("""
SELECT 'ERROR' AS level, t AS "where", 'loaded rows differ from staged rows' AS "check",
  abs(l - s)::BIGINT AS n, l || ' of ' || s AS sample
FROM (
  SELECT 'lineitem' AS t, (SELECT count(*) FROM lineitem) AS s,
    (SELECT count(DISTINCT (l_orderkey, l_linenumber)) FROM lineitem) AS l
  UNION ALL SELECT 'orders', (SELECT count(*) FROM orders),
    (SELECT count(*) FROM orders WHERE o_orderdate < DATE '2000-01-01')
  UNION ALL SELECT 'part', (SELECT count(*) FROM part), (SELECT count(*) FROM part)
  UNION ALL SELECT 'supplier', (SELECT count(*) FROM supplier), 0)
WHERE l <> s
""")
def qc_load_counts(spark: SparkSession, folder: str) -> DataFrame:
    names = ("lineitem", "orders", "part", "supplier")
    staged = {name: table(spark, folder, name) for name in names}
    held = {
        "lineitem": staged["lineitem"].select("l_orderkey", "l_linenumber").distinct(),
        "orders": staged["orders"].where("o_orderdate < date'2000-01-01'"),
        "part": staged["part"],
    }
    return loaded.count_checks(loaded.table_counts(staged), loaded.table_counts(held))


@query(union_sql(
    counted_sql("ERROR", "dim_nation", "n_nationkey has no row in the dimension", "count(*)",
                """nation WHERE n_nationkey NOT IN (
                     SELECT s_nationkey FROM supplier WHERE s_acctbal > 4000)""",
                "cast(min(n_nationkey) AS VARCHAR) AS sample"),
    counted_sql("ERROR", "dim_customer", "o_custkey has no row in the dimension", "count(*)",
                """orders WHERE o_custkey NOT IN (
                     SELECT c_custkey FROM customer WHERE c_acctbal > 0)""",
                "cast(min(o_custkey) AS VARCHAR) AS sample")))
def qc_dimensions(spark: SparkSession, folder: str) -> DataFrame:
    nations = table(spark, folder, "supplier").where("s_acctbal > 4000").select(
        F.col("s_nationkey").alias("n_nationkey"))
    customers = table(spark, folder, "customer").where("c_acctbal > 0").select(
        F.col("c_custkey").alias("o_custkey"))
    return findings.together([
        loaded.dimension_check(nations, "dim_nation", table(spark, folder, "nation"),
                               "n_nationkey"),
        loaded.dimension_check(customers, "dim_customer", table(spark, folder, "orders"),
                               "o_custkey")])


@query("""
WITH lines AS (SELECT l_orderkey, l_linenumber, cast(l_shipdate AS DATE) AS date FROM lineitem),
kept AS (SELECT * FROM lines QUALIFY row_number() OVER (
  PARTITION BY l_orderkey, l_linenumber ORDER BY date) = 1),
sides AS (
  SELECT date, count(*) AS s, (SELECT count(*) FROM kept k WHERE k.date = l.date) AS h
  FROM lines l GROUP BY date)
SELECT 'ERROR' AS level, 'fact ' || date AS "where",
  'rows differ from the processed rows' AS "check", abs(h - s)::BIGINT AS n,
  h || ' of ' || s AS sample FROM sides WHERE h <> s
""")
def qc_crawl_counts(spark: SparkSession, folder: str) -> DataFrame:
    """The fact keeps one row per line; the days that lost rows by it."""
    lines = table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", F.to_date("l_shipdate").alias("date"))
    dates = lines.select("date").distinct().withColumn(
        "date_key", F.datediff("date", F.lit("1990-01-01").cast("date")))
    kept = first_per_key(lines, ["l_orderkey", "l_linenumber"], ["date"])
    rows = kept.withColumn("date_key", F.datediff("date", F.lit("1990-01-01").cast("date")))
    return loaded.crawl_count_check(lines, rows, dates, "fact")


@query("""
WITH f AS (
  SELECT o_orderkey AS product_key, c_custkey AS retailer_key, l_linenumber AS date_key,
    p_partkey AS brand_key, c_nationkey AS category_key, NULL AS currency_key
  FROM lineitem LEFT JOIN orders ON o_orderkey = l_orderkey AND o_orderstatus <> 'P'
  LEFT JOIN customer ON c_custkey = o_custkey LEFT JOIN part ON p_partkey = l_partkey)
SELECT 'ERROR' AS level, 'fact_product_observation' AS "where", c || ' is null' AS "check", n,
  cast(NULL AS VARCHAR) AS sample
FROM (SELECT 'product_key' AS c, count(*) - count(product_key) AS n FROM f
  UNION ALL SELECT 'retailer_key', count(*) - count(retailer_key) FROM f
  UNION ALL SELECT 'date_key', count(*) - count(date_key) FROM f) WHERE n > 0
UNION ALL SELECT 'WARN', 'fact_product_observation', 'currency_key is null in every row',
  count(*), NULL FROM f
""")
def qc_fact_keys(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders").where("o_orderstatus <> 'P'").select(
        "o_orderkey", "o_custkey")
    customers = table(spark, folder, "customer").select(
        F.col("c_custkey").alias("o_custkey"), F.col("c_custkey").alias("retailer_key"),
        F.col("c_nationkey").alias("category_key"))
    parts = table(spark, folder, "part").select(
        F.col("p_partkey").alias("l_partkey"), F.col("p_partkey").alias("brand_key"))
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber")
    facts = (lines.join(orders, F.col("o_orderkey") == F.col("l_orderkey"), "left")
             .join(customers, "o_custkey", "left").join(parts, "l_partkey", "left")
             .select(F.col("o_orderkey").alias("product_key"), "retailer_key",
                     F.col("l_linenumber").alias("date_key"), "brand_key", "category_key",
                     F.lit(None).cast("bigint").alias("currency_key")))
    return loaded.fact_key_checks(facts)


@query(f"""
WITH {LABELLED}, {MONEY_ROWS}, f AS (
{union_sql(*LABELLED_NULLS, *LABELLED_CASE, LABELLED_EMPTY)}
UNION ALL SELECT 'ERROR', 'variants', 'money', count(*), NULL FROM money
  WHERE price <= 0 HAVING count(*) > 0
UNION ALL SELECT 'ERROR', 'variants', 'money', count(*), NULL FROM money
  WHERE original_price <= price HAVING count(*) > 0
UNION ALL SELECT 'ERROR', 'variants', 'money', count(*), NULL FROM money
  WHERE original_price IS NOT NULL AND price IS NULL HAVING count(*) > 0
UNION ALL SELECT 'ERROR', 'variants', 'money', count(*), NULL FROM money
  WHERE (discount IS NULL) <> (original_price IS NULL) HAVING count(*) > 0
UNION ALL SELECT 'ERROR', 'variants', 'money', count(*), NULL FROM money
  WHERE discount < 0 OR discount > 95 HAVING count(*) > 0)
SELECT level, count(*) AS findings FROM f GROUP BY level
""")
def qc_summary(spark: SparkSession, folder: str) -> DataFrame:
    """Findings of several checks by level; any error fails a run."""
    return findings.summary(qc_columns(spark, folder).unionByName(qc_money(spark, folder)))


@query(f"""
WITH {retail.STAGED_SQL}
{union_sql(
    counted_sql("ERROR", "products", "duplicate on (product, retailer, date)",
                "count(*) - count(DISTINCT (product, retailer, date))", "products"),
    counted_sql("WARN", "products", "material is null in every row",
                "CASE WHEN count(material) = 0 THEN count(*) ELSE 0 END", "products"))}
""")
def qc_products_table(spark: SparkSession, folder: str) -> DataFrame:
    """Every check of the processed products the engine itself wrote."""
    return processed.table_checks(conform.products(conformed.described(spark, folder)),
                                  "products", PROCESSED["products"])


@query("""
WITH a AS (SELECT DISTINCT l_partkey AS k FROM lineitem WHERE l_returnflag = 'A'),
b AS (SELECT DISTINCT l_partkey AS k FROM lineitem WHERE l_quantity > 40)
SELECT k AS l_partkey, 'left_only' AS side FROM a WHERE k NOT IN (SELECT k FROM b)
UNION ALL SELECT k, 'right_only' FROM b WHERE k NOT IN (SELECT k FROM a)
""")
def two_way_difference(spark: SparkSession, folder: str) -> DataFrame:
    lines = table(spark, folder, "lineitem")
    return set_difference(lines.where("l_returnflag = 'A'"), lines.where("l_quantity > 40"),
                          ["l_partkey"])


VARIANT_RULES = {
    "price at or below zero": "price <= 0", "original_price not above price":
    "original_price <= price", "original_price without price":
    "original_price IS NOT NULL AND price IS NULL",
    "sku is null": "sku IS NULL", "size is null": "size IS NULL",
    "currency is null": "currency IS NULL", "variant is null": "variant IS NULL",
    "size is not upper case": "size <> upper(size)"}
STRICT = Table.of(*(column(f.name, f.dataType, *([NAME] if f.metadata[NAME] else []))
                    for f in PROCESSED["variants"].struct.fields))


@query(f"WITH {retail.STAGED_SQL} " + union_sql(*(
    counted_sql("ERROR", "variants", check, "count(*)", f"variants WHERE {rule}",
                "min(size) AS sample" if "upper" in check else NO_SAMPLE)
    for check, rule in VARIANT_RULES.items())))
def qc_while_writing(spark: SparkSession, folder: str) -> DataFrame:
    """Findings on the variants from the pass that writes them; they are not read again."""
    rows = conformed.variants(spark, folder)
    measures = processed.measures(rows.columns, STRICT) | processed.write_measures(
        "variants", rows.columns)
    load = TableStore(spark, f"{shared_folder(spark)}/variants-{uuid.uuid4().hex}").begin()
    load.write("variants", rows, measures=measures)
    found = processed.written_checks(spark, "variants", rows.columns, load.observed["variants"],
                                     STRICT)
    return found.where(F.col("check").isin(*VARIANT_RULES))
