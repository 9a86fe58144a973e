"""Profiles, manifests and listings over the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.profile import STANDARD_ERROR, fill_rates, profile, sketches, united
from ..operators.reconcile import reconcile_crawl_files, reconcile_datasets
from ..quality import loaded
from ..sources.tables import dataset_files
from .checks import LABELLED, labelled
from .registry import query, table

PROFILED = ("doc_id", "lang", "source", "quality", "toxic", "remark")


def _rate(part: str, whole: str) -> str:
    return f"cast(round({part} / {whole}, 4) AS DECIMAL(5,4))"


@query(f"WITH {LABELLED} " + " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count(*) AS n_rows, count({c}) AS filled, "
    f"{_rate(f'count({c})', 'count(*)')} AS fill_rate, count(DISTINCT {c}) AS n_distinct "
    "FROM labelled" for c in PROFILED))
def profile_columns(spark: SparkSession, folder: str) -> DataFrame:
    return profile(labelled(spark, folder), PROFILED)


SKETCHED = ("o_orderkey", "o_custkey", "o_orderdate", "o_orderstatus", "clerk")
ORDERS = "SELECT *, CASE WHEN o_totalprice > 100000 THEN o_custkey % 100 END AS clerk FROM orders"


@query(" UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count(*) AS n_rows, count({c}) AS filled, "
    f"{_rate(f'count({c})', 'count(*)')} AS fill_rate, count(DISTINCT {c}) AS n_distinct, "
    f"true AS within FROM ({ORDERS})" for c in SKETCHED))
def profile_of_loads(spark: SparkSession, folder: str) -> DataFrame:
    """Distinct counts of two loads from their sketches, beside the exact ones.

    ``within`` says whether the estimate is no more than three standard errors off.
    """
    orders = table(spark, folder, "orders").withColumn("clerk", F.when(
        F.col("o_totalprice") > 100000, F.col("o_custkey") % 100))
    early = F.col("o_orderdate") < "1996-01-01"
    told = united(sketches(orders.where(early), SKETCHED).unionByName(
        sketches(orders.where(~early), SKETCHED))).withColumnRenamed("n_distinct", "estimate")
    exact = profile(orders, SKETCHED).select("column", "n_distinct")
    off = F.abs(F.col("estimate") - F.col("n_distinct"))
    return told.join(exact, "column").select(
        "column", "n_rows", "filled", "fill_rate", "n_distinct",
        (off <= 3 * STANDARD_ERROR * F.col("n_distinct") + 0.5).alias("within"))


@query(" UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count(*) AS n_rows, count({c}) AS filled, "
    f"{_rate(f'count({c})', 'count(*)')} AS fill_rate "
    "FROM (SELECT l_orderkey, CASE WHEN l_quantity > 25 THEN l_tax END AS l_tax, "
    "nullif(l_returnflag, 'N') AS l_returnflag FROM lineitem)"
    for c in ("l_orderkey", "l_tax", "l_returnflag")))
def fill_rate_report(spark: SparkSession, folder: str) -> DataFrame:
    return fill_rates(table(spark, folder, "lineitem").select(
        "l_orderkey", F.when(F.col("l_quantity") > 25, F.col("l_tax")).alias("l_tax"),
        F.nullif("l_returnflag", F.lit("N")).alias("l_returnflag")))


@query("""
WITH files AS (
  SELECT regexp_extract(url, '^https?://([^/]+)', 1) AS dataset, 'part-' || page_id AS file,
    length(html) AS size FROM pages),
local AS (SELECT * FROM files WHERE size > 3000),
held AS (SELECT dataset, file, CASE WHEN size > 6000 THEN size + 1 ELSE size END AS size
         FROM files WHERE size < 9000),
both_sides AS (
  SELECT coalesce(l.dataset, h.dataset) AS dataset, coalesce(l.file, h.file) AS file,
    l.size AS local_size, h.size AS held_size
  FROM local l FULL JOIN held h ON h.dataset = l.dataset AND h.file = l.file),
named AS (
  SELECT *, CASE
    WHEN dataset NOT IN (SELECT dataset FROM local) THEN 'orphan_dataset'
    WHEN dataset NOT IN (SELECT dataset FROM held) THEN 'nothing_held'
    WHEN held_size IS NULL THEN 'missing' WHEN local_size IS NULL THEN 'stale'
    WHEN local_size <> held_size THEN 'size_differs' END AS outcome FROM both_sides)
SELECT dataset, file, local_size::INTEGER AS local_size, held_size::INTEGER AS held_size, outcome
FROM named WHERE outcome IS NOT NULL
""")
def manifest_reconcile(spark: SparkSession, folder: str) -> DataFrame:
    files = table(spark, folder, "pages").select(
        F.regexp_extract("url", "^https?://([^/]+)", 1).alias("dataset"),
        F.concat(F.lit("part-"), F.col("page_id").cast("string")).alias("file"),
        F.length("html").alias("size"))
    held = files.where("size < 9000").withColumn(
        "size", F.when(F.col("size") > 6000, F.col("size") + 1).otherwise(F.col("size")))
    return reconcile_datasets(files.where("size > 3000"), held)


CRAWL_FILES = """files AS (
  SELECT source AS retailer, source || '-' || doc_id || '.json' AS file,
    'stage/' || CASE WHEN lang = 'es' THEN 'elsewhere' ELSE source END || '/' || source || '-'
      || doc_id || '.json' AS path, n_chars AS size FROM documents),
sides AS (
  SELECT l.retailer, coalesce(l.file, h.file) AS file, h.path, l.size AS local_size,
    h.size AS held_size
  FROM (SELECT * FROM files WHERE size > 500) l
  FULL JOIN (SELECT file, path, CASE WHEN size > 9000 THEN size - 1 ELSE size END AS size
             FROM files WHERE size < 12000) h ON h.file = l.file),
named AS (
  SELECT *, CASE WHEN held_size IS NULL THEN 'missing'
    WHEN local_size IS NULL THEN 'earlier_crawl' WHEN local_size <> held_size THEN 'size_differs'
    WHEN NOT contains(path, '/' || retailer || '/') THEN 'wrong_prefix' END AS outcome
  FROM sides)"""


def _crawl_files(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    source = F.col("source")
    file = F.concat(source, F.lit("-"), F.col("doc_id").cast("string"), F.lit(".json"))
    files = table(spark, folder, "documents").select(
        source.alias("retailer"), file.alias("file"),
        F.concat(F.lit("stage/"), F.when(F.col("lang") == "es", "elsewhere").otherwise(source),
                 F.lit("/"), file).alias("path"), F.col("n_chars").alias("size"))
    held = files.where("size < 12000").select("file", "path", F.when(
        F.col("size") > 9000, F.col("size") - 1).otherwise(F.col("size")).alias("size"))
    return files.where("size > 500").select("retailer", "file", "size"), held


@query(f"""
WITH {CRAWL_FILES}
SELECT retailer, file, path, local_size, held_size, outcome FROM named WHERE outcome IS NOT NULL
""")
def manifest_crawl_files(spark: SparkSession, folder: str) -> DataFrame:
    return reconcile_crawl_files(*_crawl_files(spark, folder))


@query(f"""
WITH {CRAWL_FILES}
SELECT CASE WHEN outcome = 'earlier_crawl' THEN 'WARN' ELSE 'ERROR' END AS level,
  coalesce(retailer, 'stage') AS "where", outcome AS "check", count(*) AS n, min(file) AS sample
FROM named WHERE outcome IS NOT NULL GROUP BY ALL
""")
def manifest_findings(spark: SparkSession, folder: str) -> DataFrame:
    return loaded.crawl_upload_checks(*_crawl_files(spark, folder))


@query("""
SELECT regexp_extract(url, '([^/]+)/[^/]*$', 1) AS dataset, count(*) AS files
FROM pages GROUP BY 1
""")
def dataset_listing(spark: SparkSession, folder: str) -> DataFrame:
    return dataset_files(table(spark, folder, "pages").select(F.col("url").alias("file_path")))


@query("""
SELECT o_orderstatus, count(*) AS n_rows, cast(max(o_orderdate) AS DATE) AS date
FROM orders WHERE cast(o_orderdate AS DATE) = (SELECT max(cast(o_orderdate AS DATE)) FROM orders)
GROUP BY 1
""")
def latest_crawl(spark: SparkSession, folder: str) -> DataFrame:
    """What the most recent crawl holds."""
    orders = table(spark, folder, "orders").select(
        F.to_date("o_orderdate").alias("date"), "o_orderstatus")
    newest = orders.where(F.col("date") == loaded.latest_date(orders).scalar())
    return newest.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n_rows"),
                                               F.max("date").alias("date"))
