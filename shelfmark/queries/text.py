"""Text, option, money and calendar functions over the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import (
    base_name, calendar_columns, clean_text, compact_stamp, dataset_of, discount_percent, fold,
    in_slot, is_stamp, listed, one_of, options_by_role, positive, retailer_of_file,
    sale_reference_price, stamp_of_file, upper_name,
)
from ..operators.expressions import evaluated_once
from .registry import query, table

# What the functions do, in the oracle's SQL.
CLEAN = r"nullif(trim(regexp_replace({0}, '[ \t\n\x0B\f\r]+', ' ', 'g'), ' '), '')"
UPPER = "upper(replace({0}, 'ß', 'SS'))"
FOLD = ("regexp_replace(translate(replace(replace(replace(replace(replace(replace(replace("
        "lower({0}), 'ø', 'o'), 'æ', 'ae'), 'œ', 'oe'), 'ß', 'ss'), 'đ', 'd'), 'ł', 'l'), "
        "'&', ' and '), 'áàâäãåéèêëíìîïóòôöõúùûüýñçšž', 'aaaaaaeeeeiiiiooooouuuuyncsz'), "
        "'[^a-z0-9]+', '', 'g')")


def clean_sql(text: str) -> str:
    return CLEAN.format(text)


def name_sql(text: str) -> str:
    return UPPER.format(clean_sql(text))


def fold_sql(text: str) -> str:
    return FOLD.format(text)


@query(f"""
SELECT doc_id, {clean_sql('text')} AS cleaned, {name_sql('text')} AS named FROM documents
""")
def clean_text_documents(spark: SparkSession, folder: str) -> DataFrame:
    text = F.col("text")
    return table(spark, folder, "documents").select(
        "doc_id", clean_text(text).alias("cleaned"), upper_name(text).alias("named"))


@query(f"""
SELECT 'document' AS kind, doc_id AS id, {fold_sql('text')} AS folded FROM documents
UNION ALL SELECT 'brand', p_partkey, {fold_sql('p_brand')} FROM part
""")
def fold_names(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents").select(
        F.lit("document").alias("kind"), F.col("doc_id").alias("id"),
        fold(F.col("text")).alias("folded"))
    brands = table(spark, folder, "part").select(
        F.lit("brand").alias("kind"), F.col("p_partkey").alias("id"),
        fold(F.col("p_brand")).alias("folded"))
    return documents.unionByName(brands)


# The function words that tell the documents' languages apart.
WORD_LANGUAGE = {"the": "ENGLISH", "of": "ENGLISH", "with": "ENGLISH", "le": "FRENCH",
                 "avec": "FRENCH", "und": "GERMAN", "der": "GERMAN", "el": "SPANISH",
                 "los": "SPANISH"}
_WORD_MAP = ", ".join(f"('{w}', '{v}')" for w, v in WORD_LANGUAGE.items())


@query(f"""
WITH words AS (
  SELECT DISTINCT doc_id, {fold_sql('w')} AS word
  FROM (SELECT doc_id, unnest(string_split(text, ' ') || string_split(lang, ' ')) AS w
        FROM documents)),
found AS (
  SELECT doc_id, count(DISTINCT language) AS n, min(language) AS language
  FROM words JOIN (VALUES {_WORD_MAP}) v(word, language) USING (word) GROUP BY doc_id)
SELECT d.doc_id, CASE WHEN n > 1 THEN 'SEVERAL' ELSE language END AS language
FROM documents d LEFT JOIN found USING (doc_id)
""")
def resolve_one_of(spark: SparkSession, folder: str) -> DataFrame:
    # A null text or language says nothing; the other is still read.
    none = F.array().cast("array<string>")
    words = F.concat(*(F.coalesce(F.split(c, " "), none) for c in ("text", "lang")))
    return table(spark, folder, "documents").select(
        "doc_id", one_of(words, WORD_LANGUAGE, "SEVERAL").alias("language"))


@query(f"""
WITH words AS (
  SELECT DISTINCT doc_id, {fold_sql("regexp_replace(w, '^[^:]*:', '')")} AS word
  FROM (SELECT doc_id, unnest(['Lang: ' || lang, 'lang:' || source,
    CASE WHEN doc_id % 3 = 0 THEN 'der' END]) AS w FROM documents) WHERE w IS NOT NULL),
found AS (
  SELECT doc_id, count(DISTINCT language) AS n, min(language) AS language
  FROM words JOIN (VALUES ('en', 'ENGLISH'), ('de', 'GERMAN'), ('der', 'GERMAN'),
    ('fr', 'FRENCH'), ('es', 'SPANISH')) v(word, language) USING (word) GROUP BY doc_id)
SELECT d.doc_id, CASE WHEN n > 1 THEN 'SEVERAL' ELSE language END AS language
FROM documents d LEFT JOIN found USING (doc_id)
""")
def resolve_prefixed(spark: SparkSession, folder: str) -> DataFrame:
    """Values that say what they are of: ``Lang: en`` reads as ``en``."""
    known = {"en": "ENGLISH", "de": "GERMAN", "der": "GERMAN", "fr": "FRENCH", "es": "SPANISH"}
    values = F.array(F.concat(F.lit("Lang: "), "lang"), F.concat(F.lit("lang:"), "source"),
                     F.when(F.col("doc_id") % 3 == 0, "der"))
    return table(spark, folder, "documents").select(
        "doc_id", one_of(values, known, "SEVERAL", strip_prefix=True).alias("language"))


def part_options(parts: DataFrame) -> DataFrame:
    """Parts with an options array: size and color, in an order that varies."""
    size = F.struct(F.lit(" SIZE ").alias("name"),
                    F.when(F.col("p_partkey") % 2 == 0, 1).otherwise(2).alias("position"),
                    F.array(F.col("p_size").cast("string")).alias("values"))
    color = F.struct(F.lit("Colour").alias("name"),
                     F.when(F.col("p_partkey") % 2 == 0, 2).otherwise(1).alias("position"),
                     F.split("p_name", " ").alias("values"))
    options = (F.when(F.col("p_partkey") % 5 == 0, F.array(color))
               .when(F.col("p_partkey") % 2 == 0, F.array(size, color))
               .otherwise(F.array(color, size)))
    return parts.withColumn("options", options)


@query("""
SELECT p_partkey,
  CASE WHEN p_partkey % 5 = 0 THEN NULL WHEN p_partkey % 2 = 0 THEN 1 ELSE 2 END::INTEGER
    AS size_slot,
  CASE WHEN p_partkey % 2 = 0 THEN 2 ELSE 1 END::INTEGER AS color_slot,
  CASE WHEN p_partkey % 5 = 0 THEN NULL WHEN p_partkey % 2 = 0 THEN upper(p_type)
       ELSE upper(p_brand) END AS size_value,
  replace(upper(p_name), ' ', ' / ') AS colors
FROM part
""")
def option_slots(spark: SparkSession, folder: str) -> DataFrame:
    parts = part_options(table(spark, folder, "part"))
    slots = F.array(F.concat(F.lit(" "), "p_type"), F.concat("p_brand", F.lit("  ")))
    told = evaluated_once(parts, "p_partkey", slots.alias("slots"),
                          options_by_role(F.col("options")).alias("by"))
    return told.select(
        "p_partkey", F.col("by.size.position").alias("size_slot"),
        F.col("by.color.position").alias("color_slot"),
        in_slot(F.col("slots"), F.col("by.size.position")).alias("size_value"),
        listed(F.col("by.color.values")).alias("colors"))


PRICED = """
priced AS (
  SELECT l_orderkey, l_linenumber, l_partkey,
    cast(l_extendedprice AS DECIMAL(12,2)) AS price,
    cast(CASE l_partkey % 4
      WHEN 0 THEN cast(l_extendedprice AS DECIMAL(12,2)) * 20
      WHEN 1 THEN cast(l_extendedprice AS DECIMAL(12,2)) + l_linenumber * 100
      WHEN 2 THEN cast(l_extendedprice AS DECIMAL(12,2)) * 21
      ELSE cast(l_quantity AS DECIMAL(12,2)) END AS DECIMAL(12,2)) AS compare_at
  FROM lineitem)"""


def priced_lines(lines: DataFrame) -> DataFrame:
    """Line items with a price and a stated former price: on sale, exactly on the
    steepest believable sale, beyond it, and not on sale."""
    price = F.col("l_extendedprice").cast("decimal(12,2)")
    kind = F.col("l_partkey") % 4
    compare_at = (F.when(kind == 0, (price * 20).cast("decimal(12,2)"))
                  .when(kind == 1, (price + F.col("l_linenumber") * 100).cast("decimal(12,2)"))
                  .when(kind == 2, (price * 21).cast("decimal(12,2)"))
                  .otherwise(F.col("l_quantity").cast("decimal(12,2)")))
    return lines.select("l_orderkey", "l_linenumber", "l_partkey", price.alias("price"),
                        compare_at.alias("compare_at"))


# Half-up percent in whole cents, so that no double is rounded.
PERCENT = ("cast(((({o} - {p}) * 100)::HUGEINT * 20000 + ({o} * 100)::HUGEINT) "
           "// (({o} * 200)::HUGEINT) AS DECIMAL(20,2)) / 100")


def percent_sql(price: str, original: str) -> str:
    return f"cast({PERCENT.format(p=price, o=original)} AS DECIMAL(20,2))"


@query(f"""
WITH {PRICED}, sale AS (
  SELECT *, CASE WHEN compare_at > price AND price * 20 >= compare_at THEN compare_at END
    AS original_price FROM priced)
SELECT l_orderkey, l_linenumber, l_partkey, price, original_price,
  {percent_sql('price', 'original_price')} AS discount
FROM sale
""")
def discount_rule(spark: SparkSession, folder: str) -> DataFrame:
    lines = priced_lines(table(spark, folder, "lineitem"))
    price, original = F.col("price"), F.col("original_price")
    return (lines.withColumn("original_price", sale_reference_price(price, F.col("compare_at")))
            .select("l_orderkey", "l_linenumber", "l_partkey", "price", "original_price",
                    discount_percent(price, original).alias("discount")))


@query("""
SELECT c_custkey, CASE WHEN c_acctbal > 0 THEN cast(c_acctbal AS DECIMAL(12,2)) END AS balance
FROM customer
UNION ALL
SELECT -1 - s_suppkey, CASE WHEN s_acctbal > 5000
  THEN cast(cast(s_acctbal AS DECIMAL(12,2)) - 5000 AS DECIMAL(12,2)) END
FROM supplier
""")
def positive_money(spark: SparkSession, folder: str) -> DataFrame:
    money = F.col("c_acctbal").cast("decimal(12,2)")
    customers = table(spark, folder, "customer").select(
        "c_custkey", positive(money).alias("balance"))
    owed = (F.col("s_acctbal").cast("decimal(12,2)") - 5000).cast("decimal(12,2)")
    suppliers = table(spark, folder, "supplier").select(
        (-1 - F.col("s_suppkey")).alias("c_custkey"), positive(owed).alias("balance"))
    return customers.unionByName(suppliers)


@query("""
SELECT DISTINCT cast(o_orderdate AS DATE) AS date,
  day(o_orderdate)::INTEGER AS day, week(o_orderdate)::INTEGER AS week,
  month(o_orderdate)::INTEGER AS month, quarter(o_orderdate)::INTEGER AS quarter,
  CASE WHEN month(o_orderdate) IN (12, 1, 2) THEN 'WINTER'
       WHEN month(o_orderdate) <= 5 THEN 'SPRING'
       WHEN month(o_orderdate) <= 8 THEN 'SUMMER' ELSE 'AUTUMN' END AS season,
  year(o_orderdate)::INTEGER AS year
FROM orders WHERE o_orderdate IS NOT NULL
""")
def calendar(spark: SparkSession, folder: str) -> DataFrame:
    days = (table(spark, folder, "orders").select(F.to_date("o_orderdate").alias("date"))
            .where(F.col("date").isNotNull()).distinct())
    return days.select("date", *calendar_columns(F.col("date")))


@query(r"""
WITH files AS (
  SELECT event_id, event_type || '-shop' AS retailer,
    strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS stamp FROM events),
named AS (
  SELECT *, CASE WHEN event_id % 10 = 0 THEN replace(stamp, 'T', ' ') ELSE stamp END AS given
  FROM files)
SELECT event_id, retailer AS dataset, retailer,
  replace(replace(given, '-', ''), ':', '') AS compact,
  replace(replace(stamp, '-', ''), ':', '') AS file_stamp, event_id % 10 <> 0 AS valid,
  retailer || '-' || replace(replace(stamp, '-', ''), ':', '') || '.json' AS file
FROM named
""")
def crawl_file_names(spark: SparkSession, folder: str) -> DataFrame:
    retailer = F.concat("event_type", F.lit("-shop"))
    stamp = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    named = table(spark, folder, "events").select(
        "event_id",
        F.when(F.col("event_id") % 10 == 0, F.replace(stamp, F.lit("T"), F.lit(" ")))
        .otherwise(stamp).alias("given"),
        F.concat(F.lit("stage/"), retailer, F.lit("/"), retailer, F.lit("-"),
                 compact_stamp(stamp), F.lit(".json")).alias("path"))
    file = F.col("file")
    return named.withColumn("file", base_name(F.col("path"))).select(
        "event_id", dataset_of(F.col("path")).alias("dataset"),
        retailer_of_file(file).alias("retailer"), compact_stamp(F.col("given")).alias("compact"),
        stamp_of_file(file).alias("file_stamp"), is_stamp(F.col("given")).alias("valid"), "file")
