"""Merging a run into what is held."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.merge import merge_insert_only, merge_upsert
from ..plans import conform
from .registry import query, table


@query("""
WITH held AS (SELECT p_brand AS name, min(p_type) AS tier FROM part WHERE p_size <= 2 GROUP BY 1),
current AS (SELECT p_brand AS name, max(p_type) AS tier, max(p_size) AS largest
            FROM part GROUP BY 1)
SELECT name, tier, cast(NULL AS INTEGER) AS largest FROM held
UNION ALL SELECT * FROM current WHERE name NOT IN (SELECT name FROM held)
""")
def vocab_sync(spark: SparkSession, folder: str) -> DataFrame:
    parts = table(spark, folder, "part").withColumnRenamed("p_brand", "name")
    held = parts.where("p_size <= 2").groupBy("name").agg(F.min("p_type").alias("tier"))
    current = parts.groupBy("name").agg(F.max("p_type").alias("tier"),
                                        F.max("p_size").alias("largest"))
    return conform.sync_vocabulary(held, current, "name")


@query("""
WITH held AS (SELECT p_brand AS name, min(p_type) AS tier FROM part WHERE p_size <= 2 GROUP BY 1),
current AS (SELECT p_brand AS name, max(p_type) AS tier FROM part WHERE p_size > 1 GROUP BY 1)
SELECT * FROM current UNION ALL
SELECT * FROM held WHERE name NOT IN (SELECT name FROM current)
""")
def vocab_sync_updating(spark: SparkSession, folder: str) -> DataFrame:
    parts = table(spark, folder, "part").withColumnRenamed("p_brand", "name")
    held = parts.where("p_size <= 2").groupBy("name").agg(F.min("p_type").alias("tier"))
    current = parts.where("p_size > 1").groupBy("name").agg(F.max("p_type").alias("tier"))
    return conform.sync_vocabulary(held, current, "name", update_attributes=True)


def _orders(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "orders").select(
        "o_orderkey", F.to_date("o_orderdate").alias("date"), "o_orderstatus",
        F.col("o_totalprice").cast("decimal(12,2)").alias("total"))


ORDERS_MERGED_SQL = """
WITH o AS (SELECT o_orderkey, cast(o_orderdate AS DATE) AS date, o_orderstatus,
                  cast(o_totalprice AS DECIMAL(12,2)) AS total FROM orders),
held AS (SELECT * FROM o WHERE date < DATE '1999-01-01'),
run AS (SELECT o_orderkey, date, o_orderstatus, cast(total + 1 AS DECIMAL(12,2)) AS total
        FROM o WHERE date >= DATE '1998-01-01')
SELECT * FROM held UNION ALL
SELECT * FROM run r WHERE NOT EXISTS (
  SELECT 1 FROM held h WHERE h.o_orderkey = r.o_orderkey AND h.date = r.date)
"""


def _held_and_run(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """A year is in both, with other totals in the run."""
    orders = _orders(spark, folder)
    run = orders.where("date >= date'1998-01-01'").withColumn(
        "total", (F.col("total") + 1).cast("decimal(12,2)"))
    return orders.where("date < date'1999-01-01'"), run


@query(ORDERS_MERGED_SQL, name="merge_insert_only")
def merge_orders(spark: SparkSession, folder: str) -> DataFrame:
    """A year both runs saw: the first write stays."""
    return merge_insert_only(*_held_and_run(spark, folder), ["o_orderkey", "date"])


@query(ORDERS_MERGED_SQL)
def merge_rerun(spark: SparkSession, folder: str) -> DataFrame:
    """The run merged once more, with totals changed again: the rows stay as they were."""
    held, run = _held_and_run(spark, folder)
    once = merge_insert_only(held, run, ["o_orderkey", "date"])
    again = run.withColumn("total", (F.col("total") * 2).cast("decimal(12,2)"))
    return merge_insert_only(once, again, ["o_orderkey", "date"])


@query("""
WITH held AS (SELECT p_partkey, p_name AS name, cast(p_retailprice AS DECIMAL(12,2)) AS price,
                     'held' AS origin FROM part WHERE p_type <> 'PROMO'),
run AS (SELECT p_partkey, CASE WHEN p_size > 1 THEN upper(p_name) END AS name,
               cast(cast(p_retailprice AS DECIMAL(12,2)) * 2 AS DECIMAL(12,2)) AS price
        FROM part WHERE p_size < 25)
SELECT coalesce(r.p_partkey, h.p_partkey) AS p_partkey,
  CASE WHEN r.p_partkey IS NOT NULL THEN r.name ELSE h.name END AS name,
  CASE WHEN r.p_partkey IS NOT NULL THEN r.price ELSE h.price END AS price, h.origin
FROM held h FULL JOIN run r ON r.p_partkey = h.p_partkey
""", name="merge_upsert")
def merge_parts(spark: SparkSession, folder: str) -> DataFrame:
    parts = table(spark, folder, "part")
    price = F.col("p_retailprice").cast("decimal(12,2)")
    held = parts.where("p_type <> 'PROMO'").select(
        "p_partkey", F.col("p_name").alias("name"), price.alias("price"),
        F.lit("held").alias("origin"))
    run = parts.where("p_size < 25").select(
        "p_partkey", F.when(F.col("p_size") > 1, F.upper("p_name")).alias("name"),
        (price * 2).cast("decimal(12,2)").alias("price"))
    return merge_upsert(held, run, ["p_partkey"])


@query("""
WITH held AS (SELECT c_custkey, c_mktsegment AS segment, c_nationkey AS nation
              FROM customer WHERE c_acctbal > 0),
run AS (SELECT c_custkey, lower(c_mktsegment) AS segment, -1 - c_nationkey AS nation
        FROM customer WHERE c_acctbal < 5000)
SELECT coalesce(r.c_custkey, h.c_custkey) AS c_custkey,
  coalesce(r.segment, h.segment) AS segment, coalesce(h.nation, r.nation) AS nation
FROM held h FULL JOIN run r ON r.c_custkey = h.c_custkey
""")
def merge_upsert_one_column(spark: SparkSession, folder: str) -> DataFrame:
    customers = table(spark, folder, "customer")
    held = customers.where("c_acctbal > 0").select(
        "c_custkey", F.col("c_mktsegment").alias("segment"), F.col("c_nationkey").alias("nation"))
    run = customers.where("c_acctbal < 5000").select(
        "c_custkey", F.lower("c_mktsegment").alias("segment"),
        (-1 - F.col("c_nationkey")).alias("nation"))
    return merge_upsert(held, run, ["c_custkey"], updated=["segment"])
