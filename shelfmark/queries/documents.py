"""Nested raw documents made from the given documents, then shredded and checked.

Every document becomes one crawl of a store: its lines are the pages a crawl fetched,
the words of a line the products a page delivered, the distinct words the stored
bodies. Some claims are wrong on purpose. Nothing is grouped: a row becomes a nested
document by itself, and the whole text goes into it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import trace
from ..operators.expressions import evaluated_once
from ..quality import raw as checks
from ..schemas import RAW_DOCUMENT
from ..session import cut_lineage
from ..sources import pieces, raw
from .checks import union_sql
from .registry import query, spread_table, table

STAMP = "2024-01-31T09:14:02Z"
FILE_STAMP, LATER_STAMP = "20240131T091402Z", "20240201T000000Z"


def _every(n: int) -> Column:
    return F.col("doc_id") % n == 0


def _site() -> Column:
    return F.concat(F.lit("store-"), F.col("doc_id").cast("string"))


def _file() -> Column:
    return F.concat(
        F.when(_every(19), F.concat(F.lit("other-"), F.col("doc_id").cast("string")))
        .otherwise(_site()), F.lit("-"), F.when(_every(21), LATER_STAMP).otherwise(FILE_STAMP),
        F.lit(".json"))


def raw_documents(spark: SparkSession, folder: str, *wanted: str,
                  among: DataFrame | None = None) -> DataFrame:
    """One raw crawl document per given document, with its file name.

    ``wanted`` limits the fields that are built, ``among`` (``file_path``) the documents.
    """
    lines = F.split("text", "\n")
    given = spread_table(spark, folder, "documents", "doc_id")
    if among is not None:
        given = given.join(among.select("file_path"), _file() == F.col("file_path"), "left_semi")
    paged = given.select(
        "doc_id", "n_chars", F.transform(lines, lambda line: F.split(line, " ")).alias("page_words"))
    paged = paged.withColumn("ids", F.flatten("page_words")).withColumn(
        "words", F.array_distinct("ids")).withColumn("n_pages", F.size("page_words"))
    collections = F.greatest(F.ceil((F.col("n_pages") - 3) / 5), F.lit(0)).cast("int")
    paged = paged.withColumn("n_collections", collections)

    def listing_of(page: Column) -> Column:
        return F.when(page < 3, trace.UNFILTERED).otherwise(
            F.concat(F.lit("c"), F.floor((page - 3) / 5).cast("string")))

    responses = F.transform("page_words", lambda words, i: F.struct(
        listing_of(i).alias("listing"), (i + 1).cast("long").alias("page"),
        F.lit("u").alias("url"), F.size(words).cast("long").alias("count"),
        words.alias("product_ids")))

    def listing(ix: Column) -> Column:
        # ix 0 is the unfiltered listing, which holds the first three pages.
        low, high = F.when(ix == 0, 0).otherwise(ix * 5 - 2), ix * 5 + 3
        mine = F.sequence(low, F.least(high, F.col("n_pages")) - 1)
        return F.struct(
            F.when(ix == 0, trace.UNFILTERED).otherwise(
                F.concat(F.lit("c"), (ix - 1).cast("string"))).alias("label"),
            F.size(mine).cast("long").alias("pages_fetched"),
            F.when((ix == F.col("n_collections")) & (F.col("n_chars") % 4 == 0), "error")
            .otherwise(trace.ENDED).alias("stopped_reason"),
            F.transform(F.filter(mine, lambda p: F.size(F.get("page_words", p)) < 5),
                        lambda p: p.cast("long")).alias("short_pages"),
            F.lit(0).cast("long").alias("new_products"))

    listings = F.transform(F.sequence(F.lit(0), F.col("n_collections")), listing)

    def body(word: Column) -> Column:
        length = F.length(word)
        variant = F.struct(
            F.concat(word, F.lit("-1")).alias("id"), F.upper(word).alias("sku"),
            word.alias("option1"), F.lit(None).cast("string").alias("option2"),
            F.lit(None).cast("string").alias("option3"), length.cast("string").alias("price"),
            F.lit(None).cast("string").alias("compare_at_price"),
            (length % 2 == 0).alias("available"))
        return F.struct(
            F.when(length == 1, F.concat(F.lit("x"), word)).when(length != 2, word).alias("id"),
            F.concat(F.lit("T "), word).alias("title"),
            F.nullif(F.lower(F.substring(word, 1, 1)), F.lit("")).alias("vendor"),
            F.when(length > 8, "long").otherwise("short").alias("product_type"),
            F.array(word).alias("tags"),
            F.lit(None).cast("array<struct<name string, position int, values array<string>>>")
            .alias("options"),
            F.when(length > 10, F.array(variant)).when(length == 10, F.slice(F.array(variant), 1, 0))
            .alias("variants"))

    # Every seventh store lost the first body, every ninth has one no page delivered, every
    # twenty-sixth has none at all.
    stored = F.when(_every(7), F.slice("words", 2, F.size("words"))).otherwise(F.col("words"))
    stored = F.when(_every(9), F.array_append(stored, F.lit("#extra"))).otherwise(stored)
    stored = F.when(_every(26), F.slice(stored, 1, 0)).otherwise(stored)
    initials = F.sort_array(F.array_compact(F.transform("stored", lambda w: F.nullif(
        F.lower(F.substring(w, 1, 1)), F.lit("")))))
    paged = paged.withColumn("stored", stored).withColumn("initials", initials).withColumn(
        "letters", F.array_distinct("initials"))
    products = F.map_from_entries(F.transform("stored", lambda w: F.struct(w, body(w))))
    # Counted from where each letter starts in the sorted initials.
    vendors = F.map_from_entries(F.transform("letters", lambda v, i: F.struct(
        v, F.coalesce(F.array_position("initials", F.get("letters", i + 1)),
                      F.size("initials") + 1) - F.array_position("initials", v))))
    site = _site()
    short_pages = F.size(F.filter("page_words", lambda words: F.size(words) < 5)).cast("long")
    fields = {
        "site": site, "adapter": F.lit("feed"), "base_url": F.concat(F.lit("https://"), site),
        "currency": F.when(~_every(11), "EUR"),
        "country": F.when(~_every(13), "IT").otherwise(""),
        "brand_override": F.lit(None).cast("string"),
        "scraped_at": F.when(_every(8), "yesterday").otherwise(STAMP),
        "products_received": F.size("ids").cast("long"),
        "products_stored": (F.size("stored") + F.when(_every(5), 1).otherwise(0)).cast("long"),
        "vendors": F.when(_every(6), F.map_concat(
            vendors, F.create_map(F.lit("zz"), F.lit(1).cast("long")))).otherwise(vendors),
        "complete": F.when(~_every(17), F.lit(True)),
        "pages": F.col("n_pages").cast("long"),
        "short_pages": short_pages + F.when(_every(4), 2).otherwise(0),
        "collections_crawled": F.col("n_collections").cast("long"),
        "listings": listings,
        "errors": F.when(_every(10), F.array(F.struct(
            F.lit("c0").alias("listing"), F.lit(7).cast("long").alias("page"),
            F.lit("HTTP 500").alias("error")))).otherwise(F.array()),
        "throttled": F.when(_every(3), F.col("doc_id")).otherwise(0),
        "rate_limit_start": F.lit(1.0), "rate_limit_final": F.lit(0.5),
        "responses": responses, "products": products,
        "file": _file(),
    }
    return evaluated_once(paged, *(
        column.alias(name) for name, column in fields.items() if not wanted or name in wanted))


def parsed_documents(spark: SparkSession, folder: str) -> DataFrame:
    """The same through JSON text and the declared schema, as files are read."""
    documents = raw_documents(spark, folder)
    text = F.to_json(F.struct(*(c for c in documents.columns if c != "file")))
    parsed = F.from_json(text, RAW_DOCUMENT).alias("d")
    return evaluated_once(documents, "file", parsed).select("file", "d.*")


BASE = """pages AS (
  SELECT doc_id, n_chars, i, string_split(lines[i + 1], ' ') AS words FROM (
    SELECT doc_id, n_chars, string_split(text, chr(10)) AS lines FROM documents) d,
    unnest(range(len(lines))) t(i)),
sizes AS (
  SELECT doc_id, any_value(n_chars) AS n_chars, count(*) AS n_pages,
    greatest(ceil((count(*) - 3) / 5.0), 0)::BIGINT AS n_collections,
    sum(len(words))::BIGINT AS received, count(*) FILTER (len(words) < 5) AS short_pages
  FROM pages GROUP BY 1),
delivered AS (
  SELECT doc_id, i AS seq, p AS pos, words[p + 1] AS word,
    CASE WHEN i < 3 THEN '*unfiltered*' ELSE 'c' || ((i - 3) // 5) END AS listing
  FROM pages, unnest(range(len(words))) t(p)),
firsts AS (
  SELECT * FROM delivered QUALIFY row_number() OVER (
    PARTITION BY doc_id, word ORDER BY seq, pos) = 1),
stored AS (
  SELECT doc_id, word FROM firsts
  WHERE NOT (doc_id % 7 = 0 AND seq = 0 AND pos = 0) AND doc_id % 26 <> 0
  UNION ALL SELECT doc_id, '#extra' FROM documents WHERE doc_id % 9 = 0 AND doc_id % 26 <> 0),
bodies AS (
  SELECT doc_id, word, CASE WHEN length(word) = 1 THEN 'x' || word
      WHEN length(word) <> 2 THEN word END AS body_id,
    nullif(lower(substr(word, 1, 1)), '') AS vendor FROM stored),
counts AS (
  SELECT doc_id, count(*) AS held, count(*) FILTER (word <> coalesce(body_id, '?'))
    AS foreign_ids FROM bodies GROUP BY 1),
docs AS (
  SELECT *, coalesce(held, 0) AS n_stored, coalesce(foreign_ids, 0) AS n_foreign,
    'store-' || doc_id AS site,
    CASE WHEN doc_id % 8 = 0 THEN 'yesterday' ELSE '2024-01-31T09:14:02Z' END AS scraped_at,
    CASE WHEN doc_id % 19 = 0 THEN 'other-' ELSE 'store-' END || doc_id
      || CASE WHEN doc_id % 21 = 0 THEN '-20240201T000000Z' ELSE '-20240131T091402Z' END
      || '.json' AS file,
    coalesce(held, 0) + CASE WHEN doc_id % 5 = 0 THEN 1 ELSE 0 END AS claimed,
    short_pages + CASE WHEN doc_id % 4 = 0 THEN 2 ELSE 0 END AS claimed_short,
    n_chars % 4 <> 0 AS ended
  FROM sizes LEFT JOIN counts USING (doc_id)),
sound AS (SELECT * FROM docs WHERE doc_id % 17 <> 0)"""


PRODUCTS_SQL = f"""
WITH {BASE}
SELECT site, scraped_at, coalesce(body_id, word) AS id, 'T ' || word AS title, vendor,
  CASE WHEN length(word) > 8 THEN 'long' ELSE 'short' END AS product_type
FROM bodies JOIN docs USING (doc_id)
"""


@query(PRODUCTS_SQL)
def shred_documents(spark: SparkSession, folder: str) -> DataFrame:
    rows = raw.product_rows(raw.document_bodies(parsed_documents(spark, folder)))
    return rows.select("site", "scraped_at", "id", "title", "vendor", "product_type")


@query(PRODUCTS_SQL)
def shred_split_bodies(spark: SparkSession, folder: str) -> DataFrame:
    """The same out of indented texts, cut where a product closes."""
    documents = raw_documents(spark, folder, "file", "site", "scraped_at", "products")
    texts = documents.select(F.col("file").alias("file_path"), F.to_json(
        F.struct("site", "scraped_at", "products"), {"pretty": "true"}).alias("text"))
    marked = pieces.marked(pieces.cut_text(texts))
    rows = raw.product_rows(raw.split_bodies(marked, pieces.summary(marked)))
    return rows.select("site", "scraped_at", "id", "title", "vendor", "product_type")


@query(f"""
WITH {BASE}
SELECT site, scraped_at, word AS product_id, word || '-1' AS id, upper(replace(word, 'ß', 'SS')) AS sku,
  word AS option1, length(word)::VARCHAR AS price, length(word) % 2 = 0 AS available
FROM bodies JOIN docs USING (doc_id) WHERE length(word) > 10
""")
def shred_variants(spark: SparkSession, folder: str) -> DataFrame:
    rows = raw.variant_rows(raw.document_bodies(parsed_documents(spark, folder)))
    return rows.select("site", "scraped_at", "product_id", "id", "sku", "option1", "price",
                       "available")


@query(f"""
WITH {BASE}, tally AS (SELECT doc_id, vendor, count(*) AS products FROM bodies
                       WHERE vendor IS NOT NULL GROUP BY ALL)
SELECT site, received AS products_received, claimed AS products_stored, n_pages AS pages,
  n_collections AS collections_crawled, vendor, products
FROM docs JOIN (SELECT * FROM tally UNION ALL
                SELECT doc_id, 'zz', 1 FROM documents WHERE doc_id % 6 = 0) USING (doc_id)
""")
def crawl_records(spark: SparkSession, folder: str) -> DataFrame:
    records = raw.crawl_records(parsed_documents(spark, folder))
    return records.select("site", "products_received", "products_stored", "pages",
                          "collections_crawled", F.inline("vendors"))


@query(f"""
WITH {BASE}
SELECT site, count(*) AS products, count(*) FILTER (length(word) > 10) AS variants
FROM bodies JOIN docs USING (doc_id) GROUP BY ROLLUP (site)
""")
def shred_counts(spark: SparkSession, folder: str) -> DataFrame:
    documents = raw_documents(spark, folder)
    # The crawls are not counted; the bodies come from documents built with no more than they need.
    return raw.shred_counts(raw.shred(documents, raw.document_bodies(raw_documents(
        spark, folder, "site", "scraped_at", "products"))))


@query(f"""
WITH {BASE}
SELECT site, word AS product_id, listing, seq::INTEGER AS seq, pos::INTEGER AS pos
FROM firsts JOIN docs USING (doc_id)
""")
def page_first_delivery(spark: SparkSession, folder: str) -> DataFrame:
    # Dealt as pages, the ids of a crawl are together before they are rows: no row of an id is
    # sorted or shuffled that way. A crawl is one document here, which one task has made.
    pages = raw.responses(raw_documents(spark, folder, "site", "scraped_at", "responses"))
    delivered = trace.deliveries(pages.repartition(*trace.CRAWL))
    return trace.first_deliveries(delivered).select("site", "product_id", "listing", "seq", "pos")


@query(f"""
WITH {BASE}
SELECT site, scraped_at, received AS products_received, n_stored AS products_stored,
  n_pages AS pages, short_pages, n_collections AS collections_crawled, ended AS complete
FROM docs
""")
def crawl_counters(spark: SparkSession, folder: str) -> DataFrame:
    def only(field: str) -> DataFrame:
        return raw_documents(spark, folder, "site", "scraped_at", field)

    return trace.crawl_counters(raw.responses(only("responses")),
                                raw.listings(only("listings")), raw.stored_products(
                                    raw.document_bodies(only("products"))))


@query(f"""
WITH {BASE}
SELECT site, ended AS complete FROM docs
""")
def complete_flag(spark: SparkSession, folder: str) -> DataFrame:
    return raw_documents(spark, folder, "site", "listings").select("site", F.forall(
        "listings", lambda item: item["stopped_reason"] == trace.ENDED).alias("complete"))


@query(f"""
WITH {BASE}
SELECT site, 'error' AS stopped_reason, 1::BIGINT AS listings FROM docs WHERE NOT ended
""")
def stop_reasons(spark: SparkSession, folder: str) -> DataFrame:
    return trace.stop_reasons(raw.listings(raw_documents(
        spark, folder, "site", "scraped_at", "listings")), ["site"])


def _found_sql(level: str, check: str, rule: str, n: str = "1",
               sample: str = "NULL", rows: str = "sound") -> str:
    return (f"SELECT '{level}' AS level, file AS \"where\", '{check}' AS \"check\", "
            f"({n})::BIGINT AS n, cast({sample} AS VARCHAR) AS sample FROM {rows} WHERE {rule}")


# What a document claims and what it holds, met anew by file and name.
MET = """page_ids AS (SELECT DISTINCT doc_id, word FROM delivered),
met AS (
  SELECT doc_id, count(*) FILTER (s.word IS NULL) AS bodiless,
    count(*) FILTER (p.word IS NULL) AS untraced
  FROM page_ids p FULL JOIN stored s USING (doc_id, word) GROUP BY 1),
tally AS (SELECT doc_id, vendor, count(*) AS n FROM bodies WHERE vendor IS NOT NULL GROUP BY ALL),
off AS (
  SELECT doc_id, count(*) AS off_vendors, min(vendor) AS off_vendor FROM (
    SELECT doc_id, vendor FROM (
      SELECT doc_id, vendor, n FROM tally
      UNION ALL SELECT doc_id, vendor, -n FROM tally
      UNION ALL SELECT doc_id, 'zz', -1 FROM documents WHERE doc_id % 6 = 0)
    GROUP BY ALL HAVING sum(n) <> 0) GROUP BY 1),
checked AS (
  SELECT sound.*, n_pages AS claimed_pages, coalesce(bodiless, 0) AS bodiless,
    coalesce(untraced, 0) AS untraced, coalesce(off_vendors, 0) AS off_vendors, off_vendor
  FROM sound LEFT JOIN met USING (doc_id) LEFT JOIN off USING (doc_id))"""
# The same of the texts that are not damaged, some of which have a null for their pages.
MET_IN_TEXTS = MET.replace("n_pages AS", "CASE WHEN doc_id % 23 <> 0 THEN n_pages END AS").replace(
    "LEFT JOIN off USING (doc_id))", "LEFT JOIN off USING (doc_id) WHERE doc_id % 29 <> 0 "
    "AND doc_id % 31 <> 0 AND doc_id % 37 <> 0)")


def _differs(name: str, claimed: str, held: str) -> str:
    return _found_sql("ERROR", f"{name} differs from what is held",
                      f"{claimed} IS DISTINCT FROM {held}", rows="checked",
                      sample=f"coalesce({claimed}::VARCHAR, 'null') || ' holds ' || {held}")


def _checked(level: str, check: str, n: str, sample: str = "NULL") -> str:
    return _found_sql(level, check, f"({n}) > 0", n, sample, "checked")


PARSED = "try_strptime(scraped_at, '%Y-%m-%dT%H:%M:%SZ')"
SELF_SQL = union_sql(
    _differs("products_stored", "claimed", "n_stored"),
    _differs("short_pages", "claimed_short", "short_pages"),
    _differs("pages", "claimed_pages", "n_pages"),
    _checked("ERROR", "id on a page without a body", "bodiless"),
    _checked("ERROR", "body on no page", "untraced"),
    _checked("ERROR", "body keyed by a foreign id", "n_foreign"),
    _checked("ERROR", "complete contradicts the listings", "(NOT ended)::INT"),
    _checked("ERROR", "site is not the one in the file name",
             "(NOT starts_with(file, site || '-'))::INT", "site"),
    _checked("ERROR", "scraped_at is not a UTC stamp", f"({PARSED} IS NULL)::INT", "scraped_at"),
    _checked("ERROR", "stamp is not the one in the file name",
             f"({PARSED} IS NOT NULL AND NOT contains(file, replace(replace("
             "scraped_at, '-', ''), ':', '')))::INT"))
VENDOR_SQL = _checked("ERROR", "vendors differ from the bodies", "off_vendors", "off_vendor")
THIN_SQL = union_sql(
    _checked("WARN", "no products", "(n_stored = 0)::INT"),
    _checked("WARN", "listing cut off", "(NOT ended)::INT", "'error'"),
    _checked("WARN", "failed request", "(doc_id % 10 = 0)::INT", "'HTTP 500'"),
    _checked("WARN", "throttled", "CASE WHEN doc_id % 3 = 0 THEN doc_id ELSE 0 END",
             "'rate now 0.5/s'"),
    _checked("WARN", "page under 250 items beyond the closing ones",
             "CASE WHEN claimed_pages > 0 THEN claimed_short - (n_collections + ended::INT) END"),
    _checked("WARN", "no currency", "(doc_id % 11 = 0)::INT"),
    _checked("WARN", "no country", "(doc_id % 13 = 0)::INT"))

CLAIMED = ("site", "adapter", "base_url", "currency", "country", "brand_override", "scraped_at",
           "products_received", "products_stored", "complete", "pages", "short_pages",
           "collections_crawled", "throttled", "rate_limit_start", "rate_limit_final")
LISTS = ("listings", "errors", "responses")


def _measured(spark: SparkSession, folder: str) -> DataFrame:
    documents = raw_documents(spark, folder, "file", "products", "vendors", *LISTS)
    claimed = F.to_json(F.struct(*CLAIMED))
    # Containers stand for themselves empty; what they hold is in the rows.
    text = F.concat(F.substring(claimed, F.lit(1), F.length(claimed) - 1), F.lit(
        ', "listings": [], "errors": [], "responses": [], "products": {}, "vendors": {}}'))
    tops = raw_documents(spark, folder, "file", *CLAIMED).select("file", text.alias("text"))
    parts = raw.parts_of_documents(documents, tops)
    return checks.against_held(checks.top_level(parts.tops), checks.held_numbers(parts.rows))


@query(f"WITH {BASE}, {MET} {SELF_SQL}")
def trace_check(spark: SparkSession, folder: str) -> DataFrame:
    """Every claim of a document recomputed, bodies against pages both ways."""
    return checks.self_checks(_measured(spark, folder))


@query(f"WITH {BASE}, {MET} {VENDOR_SQL}")
def vendor_check(spark: SparkSession, folder: str) -> DataFrame:
    return checks.vendor_check(_measured(spark, folder))


@query(f"WITH {BASE}, {MET} {THIN_SQL}")
def thinness_check(spark: SparkSession, folder: str) -> DataFrame:
    return checks.thinness_checks(_measured(spark, folder))


def _inner(text: Column) -> Column:
    return F.substring(text, F.lit(2), F.length(text) - 2)


def _field(column: Column, name: str, nulls: bool) -> Column:
    """``"name":value`` as JSON; empty for a null unless ``nulls``."""
    return _inner(F.to_json(F.struct(column.alias(name)), {
        "ignoreNullFields": "false" if nulls else "true"}))


def _object(struct: Column, names: list[str]) -> Column:
    # A quote within a text is escaped, so what is replaced are names behind a comma. Inner
    # objects share none of them but the first, which has a brace before it.
    told = F.regexp_replace(_inner(F.to_json(struct)), f',(?="(?:{"|".join(names[1:])})":)',
                            ",\n      ")
    return F.concat(F.lit("{\n      "), told, F.lit("\n    }"))


def _container(name: str, entries: Column, brackets: str) -> Column:
    # Each entry is told once; the array is empty where the column is.
    some = F.concat(F.lit(brackets[0] + "\n    "), F.array_join(entries, ",\n    "),
                    F.lit("\n  " + brackets[1]))
    return F.concat(F.lit(f'"{name}": '), F.when(F.size(name) > 0, some).otherwise(brackets))


def _named(key: Column) -> Column:
    return F.regexp_replace(_inner(F.to_json(F.create_map(key, F.lit(0)))), ":0$", ": ")


def document_texts(spark: SparkSession, folder: str,
                   among: DataFrame | None = None) -> DataFrame:
    """``file_path, text``: the documents as files hold them, some of them damaged.

    ``among`` (``file_path``) limits the documents. Every seventeenth lacks a field, every 23rd has a null counter, every 29th an object
    for a list, every 31st is cut short, every 37th stands within a list.
    """
    documents = raw_documents(spark, folder, among=among)
    types = documents.schema
    names = {c: types[c].dataType.elementType.names for c in LISTS}
    doc = F.regexp_extract("base_url", r"(\d+)$", 1).cast("long")

    def top(name: str) -> Column:
        if name == "complete":
            return _field(F.col(name), name, False)
        return _field(F.when(doc % 23 != 0, F.col(name)) if name == "pages" else F.col(name),
                      name, True)

    def listed(name: str) -> Column:
        whole = _container(name, F.transform(name, lambda e: _object(e, names[name])), "[]")
        return F.when(doc % 29 == 0, '"errors": {}').otherwise(whole) if name == "errors" \
            else whole

    fields = [
        *map(top, CLAIMED),
        _container("vendors", F.transform(F.map_entries("vendors"), lambda e: F.concat(
            _named(e["key"]), e["value"].cast("string"))), "{}"),
        *map(listed, LISTS),
        _container("products", F.transform(F.map_entries("products"), lambda e: F.concat(
            _named(e["key"]), _object(e["value"], types["products"].dataType.valueType.names))),
            "{}")]
    text = F.concat(F.lit("{\n  "), F.array_join(F.array_remove(F.array(*fields), ""), ",\n  "),
                    F.lit("\n}"))
    whole = evaluated_once(documents, F.col("file").alias("file_path"), doc.alias("doc"),
                           text.alias("whole"))
    return whole.select("file_path", F.when(F.col("doc") % 31 == 0, F.substring(
        "whole", F.lit(1), F.length("whole") - 3)).when(F.col("doc") % 37 == 0, F.concat(
            F.lit("["), "whole", F.lit("]"))).otherwise(F.col("whole")).alias("text"))


READABLE = "doc_id % 31 <> 0 AND doc_id % 37 <> 0"


@query(f"WITH {BASE} " + union_sql(
    _found_sql("ERROR", "complete is missing", f"doc_id % 17 = 0 AND {READABLE}", rows="docs"),
    _found_sql("ERROR", "errors is not a list", f"doc_id % 29 = 0 AND {READABLE}",
               sample="'OBJECT'", rows="docs"),
    _found_sql("ERROR", "invalid JSON", "doc_id % 31 = 0", rows="docs"),
    _found_sql("ERROR", "root is not an object", "doc_id % 37 = 0 AND doc_id % 31 <> 0",
               sample="'ARRAY'", rows="docs")))
def raw_structure_check(spark: SparkSession, folder: str) -> DataFrame:
    """Absent, null and of a wrong type told apart, out of pieces where a text can be cut."""
    files = cut_lineage(pieces.summary(pieces.marked(pieces.cut_text(
        document_texts(spark, folder)))).where("file_path IS NOT NULL"))
    # Whole texts are told again for the odd files alone; a file that is not odd is one document.
    whole = document_texts(spark, folder, files.where("odd"))
    tops = whole.unionByName(files.where("NOT odd").select("file_path", "text"))
    return checks.structure_checks(checks.top_level(
        tops.select(F.col("file_path").alias("file"), "text")))


@query(f"WITH {BASE}, {MET_IN_TEXTS} " + union_sql(SELF_SQL, VENDOR_SQL, THIN_SQL))
def raw_split_checks(spark: SparkSession, folder: str) -> DataFrame:
    """All checks of documents cut into pieces: no row holds more than a product or a page."""
    marked = pieces.marked(pieces.cut_text(document_texts(spark, folder)))
    return checks.measured_checks(raw.parts_at_once(marked))


@query(f"""
WITH {BASE}
SELECT 'WARN' AS level, 'coverage' AS "where", 'crawl of no enabled site' AS "check",
  count(*)::BIGINT AS n, string_agg(s, ', ' ORDER BY s) AS sample
FROM (SELECT DISTINCT CASE WHEN doc_id % 19 = 0 THEN 'other-' || doc_id ELSE site END AS s FROM docs)
WHERE s NOT IN (SELECT 'store-' || doc_id FROM labels) HAVING count(*) > 0
UNION ALL
SELECT 'WARN', 'coverage', 'enabled site never crawled', count(*), string_agg(s, ', ' ORDER BY s)
FROM (SELECT 'store-' || doc_id AS s FROM labels
      WHERE doc_id % 19 = 0 OR doc_id NOT IN (SELECT doc_id FROM docs)) HAVING count(*) > 0
""")
def raw_site_check(spark: SparkSession, folder: str) -> DataFrame:
    sites = table(spark, folder, "labels").select(
        F.concat(F.lit("store-"), F.col("doc_id").cast("string")).alias("site"))
    return checks.site_checks(raw_documents(spark, folder, "file"), sites)


@query("""
SELECT 'ERROR' AS level, 'crawl' AS "where", 'more than one crawl stamp' AS "check",
  count(*)::BIGINT AS n, min(s) AS sample
FROM (SELECT DISTINCT strftime(ts, '%Y%m%dT%H%M%SZ') AS s FROM events) HAVING count(*) > 1
""")
def raw_stamp_check(spark: SparkSession, folder: str) -> DataFrame:
    files = table(spark, folder, "events").select(F.concat(
        F.col("event_type"), F.lit("-"), F.date_format("ts", "yyyyMMdd'T'HHmmss'Z'"),
        F.lit(".json")).alias("file"))
    return checks.stamp_check(files)
