"""Checks of a load: the history against the run, the star schema against the history."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.profile import rate, unpivot_row
from ..operators.reconcile import reconcile_crawl_files, reconcile_datasets
from ..schemas import PROCESSED
from .findings import ERROR, WARN, finding, raised, together

REQUIRED_FACT_KEYS = ("product_key", "retailer_key", "date_key")
OPTIONAL_FACT_KEYS = ("brand_key", "category_key", "currency_key")


def latest_date(products: DataFrame) -> DataFrame:
    """The date of the most recent crawl, as one row ``date``."""
    return products.agg(F.max("date").alias("date"))


def table_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """``table, n_rows``; an empty table counts as zero."""
    return together(frame.agg(F.count(F.lit(1)).alias("n_rows"))
                    .select(F.lit(name).alias("table"), "n_rows")
                    for name, frame in tables.items())


def count_checks(staged: DataFrame, loaded: DataFrame) -> DataFrame:
    """Tables whose loaded rows differ from the staged ones; both are ``table_counts``."""
    both = staged.withColumnRenamed("n_rows", "_s").join(
        loaded.withColumnRenamed("n_rows", "_l"), "table", "full_outer")
    held, sent = F.coalesce("_l", F.lit(0)), F.coalesce("_s", F.lit(0))
    return raised(both, [finding(
        ERROR, F.col("table"), "loaded rows differ from staged rows", F.abs(held - sent),
        F.concat_ws(" of ", held.cast("string"), sent.cast("string")))])


def processed_load_checks(run: Mapping[str, DataFrame], history: Mapping[str, DataFrame],
                          date: str | None = None) -> DataFrame:
    """Replaced tables whole, cumulative ones only for the crawl of ``date``.

    By default that is the newest crawl whose products the history holds.
    """
    day = (F.lit(date).cast("date") if date is not None
           else latest_date(history["products"]).scalar())
    loaded = {name: history[name].where(F.col("date") == day) if spec.cumulative
              else history[name] for name, spec in PROCESSED.items()}
    return count_checks(table_counts({t: run[t] for t in loaded}), table_counts(loaded))


def dimension_check(dimension: DataFrame, name: str, source: DataFrame, key: str) -> DataFrame:
    """Processed values that did not reach their dimension."""
    missing = (source.select(key).where(F.col(key).isNotNull())
               .join(dimension.select(key), key, "left_anti")
               .agg(F.count(F.lit(1)).alias("_n"), F.min(key).alias("_s")))
    return raised(missing, [finding(ERROR, name, f"{key} has no row in the dimension",
                                    F.col("_n"), F.col("_s"))])


def dimension_checks(processed: Mapping[str, DataFrame],
                     model: Mapping[str, DataFrame]) -> DataFrame:
    return together(dimension_check(model[spec.dimension], spec.dimension, processed[table],
                                    spec.grain[0])
                    for table, spec in PROCESSED.items() if spec.dimension)


def crawl_counts(rows: DataFrame, dates: DataFrame) -> DataFrame:
    """``date, n_rows`` of rows that carry a ``date_key``.

    Counted per key before the date is joined on, so one row per crawl is joined.
    """
    counted = rows.groupBy("date_key").agg(F.count(F.lit(1)).alias("n_rows"))
    return counted.join(dates.select("date_key", "date"), "date_key").select("date", "n_rows")


def crawl_count_check(source: DataFrame, rows: DataFrame, dates: DataFrame, name: str,
                      date: str | None = None) -> DataFrame:
    """Crawls whose rows in the model differ from the processed ones they came from.

    This is what shows rows an inner join dropped. ``date`` limits it to one crawl.
    """
    sent = source.groupBy("date").agg(F.count(F.lit(1)).alias("_s"))
    both = sent.join(crawl_counts(rows, dates).withColumnRenamed("n_rows", "_l"),
                     "date", "full_outer")
    if date is not None:
        both = both.where(F.col("date") == F.lit(date).cast("date"))
    held, given = F.coalesce("_l", F.lit(0)), F.coalesce("_s", F.lit(0))
    off = both.withColumn("_off", F.abs(held - given)).withColumn(
        "_text", F.concat_ws(" of ", held.cast("string"), given.cast("string")))
    return raised(off, [finding(
        ERROR, F.concat_ws(" ", F.lit(name), F.col("date").cast("string")),
        "rows differ from the processed rows", F.col("_off"), F.col("_text"))])


def fact_key_checks(facts: DataFrame) -> DataFrame:
    """Null keys, required ones and optional ones that are null throughout; one pass."""
    name = "fact_product_observation"
    row = facts.agg(F.count(F.lit(1)).alias("_rows"), *(
        F.count(c).alias(f"_filled_{c}") for c in REQUIRED_FACT_KEYS + OPTIONAL_FACT_KEYS))
    rows = F.col("_rows")
    return raised(row, [
        *(finding(ERROR, name, f"{c} is null", rows - F.col(f"_filled_{c}"))
          for c in REQUIRED_FACT_KEYS),
        *(finding(WARN, name, f"{c} is null in every row",
                  F.when(F.col(f"_filled_{c}") == 0, rows).otherwise(0))
          for c in OPTIONAL_FACT_KEYS),
    ])


def fact_coverage(facts: DataFrame) -> DataFrame:
    """How much of the fact carries a brand, category and currency key."""
    row = facts.agg(F.count(F.lit(1)).alias("n_rows"),
                    *(F.count(c).alias(f"_filled_{c}") for c in OPTIONAL_FACT_KEYS))
    return unpivot_row(row, OPTIONAL_FACT_KEYS, filled="_filled_").select(
        "column", "n_rows", "filled", rate(F.col("filled"), F.col("n_rows")).alias("coverage"))


def analytical_load_checks(processed: Mapping[str, DataFrame], model: Mapping[str, DataFrame],
                           date: str | None = None) -> DataFrame:
    dates, facts = model["dim_date"], model["fact_product_observation"]
    return together([
        dimension_checks(processed, model),
        crawl_count_check(processed["products"], model["dim_product"], dates,
                          "dim_product", date),
        crawl_count_check(processed["variants"], facts, dates,
                          "fact_product_observation", date),
        fact_key_checks(facts),
    ])


def dataset_upload_checks(local: DataFrame, held: DataFrame) -> DataFrame:
    """An upload of datasets as findings, one per dataset and outcome."""
    return (reconcile_datasets(local, held)
            .groupBy(F.col("dataset").alias("where"), F.col("outcome").alias("check"))
            .agg(F.count(F.lit(1)).alias("n"), F.min("file").alias("sample"))
            .select(F.lit(ERROR).alias("level"), "where", "check", "n", "sample"))


def crawl_upload_checks(local: DataFrame, held: DataFrame) -> DataFrame:
    """An upload of raw crawl files as findings; leftovers only warn."""
    return (reconcile_crawl_files(local, held)
            .groupBy(F.coalesce("retailer", F.lit("stage")).alias("where"),
                     F.col("outcome").alias("check"))
            .agg(F.count(F.lit(1)).alias("n"), F.min("file").alias("sample"))
            .select(F.when(F.col("check") == "earlier_crawl", WARN).otherwise(ERROR)
                    .alias("level"), "where", "check", "n", "sample"))
