"""Checks of the processed tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.money import MAX_DISCOUNT_PERCENT
from ..local import stated_rows
from ..operators.reconcile import set_difference
from ..schemas import PROCESSED, Table
from .findings import ERROR, WARN, finding, raised, stated, together


def measures(columns: Sequence[str], spec: Table) -> dict[str, Column]:
    """What the checks of columns rest on: aggregates of one pass over the rows."""
    held = {"rows": F.count(F.lit(1))}
    for c in columns:
        held[f"filled_{c}"] = F.count(c)
        if c in spec.names:
            off = F.col(c) != F.upper(c)
            held |= {f"case_{c}": F.count_if(off), f"sample_{c}": F.min(F.when(off, F.col(c)))}
    return held


def judged(row: DataFrame, columns: Sequence[str], name: str, spec: Table) -> DataFrame:
    """Findings of one row of ``measures``: rows present, nulls, case and empty columns."""
    rows = F.col("rows")
    return raised(row, [
        finding(ERROR, name, "no rows", F.when(rows == 0, 1).otherwise(0)),
        *(finding(ERROR, name, f"{c} is null", rows - F.col(f"filled_{c}"))
          for c in spec.filled if c in columns),
        *(finding(ERROR, name, f"{c} is not upper case", F.col(f"case_{c}"),
                  F.col(f"sample_{c}")) for c in spec.names if c in columns),
        *(finding(WARN, name, f"{c} is null in every row",
                  F.when(F.col(f"filled_{c}") == 0, rows).otherwise(0))
          for c in columns if c not in spec.filled)])


def column_checks(frame: DataFrame, name: str, spec: Table) -> DataFrame:
    """Rows present, nulls, case and empty columns, all from one aggregate."""
    row = frame.agg(*(m.alias(n) for n, m in measures(frame.columns, spec).items()))
    return judged(row, frame.columns, name, spec)


def write_measures(table: str, columns: Sequence[str]) -> dict[str, Column]:
    """Aggregates to take of a processed table while it is written (``Load.write``)."""
    held = measures(columns, PROCESSED[table])
    if table == "variants":
        held |= {f"money_{i}": F.count_if(rule) for i, (_, rule) in enumerate(money_rules())}
    return held


def written_checks(spark: SparkSession, table: str, columns: Sequence[str],
                   observed: Mapping[str, object], spec: Table | None = None) -> DataFrame:
    """Findings of a table from what was observed as it was written; it is not read again."""
    kinds = {n: pa.string() if n.startswith("sample_") else pa.int64() for n in observed}
    row = stated_rows(spark, kinds, [tuple(observed.values())])
    found = judged(row, columns, table, spec or PROCESSED[table])
    if table != "variants":
        return found
    return found.unionByName(raised(row, [
        finding(ERROR, table, label, F.col(f"money_{i}"))
        for i, (label, _) in enumerate(money_rules())]))


def grain_check(frame: DataFrame, name: str, grain: Sequence[str]) -> DataFrame:
    """Rows beyond the first on one grain. Repeats are folded before the shuffle."""
    repeats = (frame.groupBy(*grain).agg(F.count(F.lit(1)).alias("_n"))
               .agg(F.sum(F.col("_n") - 1).alias("_extra")))
    return raised(repeats, [finding(
        ERROR, name, f"duplicate on ({', '.join(grain)})", F.col("_extra"))])


def table_checks(frame: DataFrame, name: str, spec: Table) -> DataFrame:
    missing = [c for c in dict.fromkeys((*spec.grain, *spec.filled)) if c not in frame.columns]
    if missing:
        return stated(frame.sparkSession, [
            (ERROR, name, f"{c} is missing", 1, None) for c in missing])
    return column_checks(frame, name, spec).unionByName(
        grain_check(frame, name, spec.grain))


def vocabulary_check(frame: DataFrame, name: str, column: str, vocabulary: DataFrame,
                     key: str, vocabulary_name: str) -> DataFrame:
    """Distinct values the vocabulary lacks. Null is allowed."""
    values = frame.select(F.col(column).alias("_v")).where(F.col("_v").isNotNull()).distinct()
    unknown = values.join(vocabulary.select(F.col(key).alias("_v")), "_v", "left_anti")
    row = unknown.agg(F.count(F.lit(1)).alias("_n"), F.min("_v").alias("_s"))
    return raised(row, [finding(ERROR, name, f"{column} not in {vocabulary_name}",
                                F.col("_n"), F.col("_s"))])


def orphan_check(frame: DataFrame, name: str, parent: DataFrame, parent_name: str,
                 keys: Sequence[str]) -> DataFrame:
    """Distinct keys without a parent row; reduced to keys before they meet."""
    orphans = frame.select(*keys).distinct().join(
        parent.select(*keys).distinct(), list(keys), "left_anti")
    row = orphans.agg(F.count(F.lit(1)).alias("_n"))
    return raised(row, [finding(ERROR, name, f"not in {parent_name}", F.col("_n"))])


def money_rules() -> list[tuple[str, Column]]:
    """What prices may not look like, over ``price, original_price, discount``."""
    price, original, discount = (F.col(c) for c in ("price", "original_price", "discount"))
    return [
        ("price at or below zero", price <= 0),
        ("original_price not above price", original <= price),
        ("original_price without price", original.isNotNull() & price.isNull()),
        ("discount and original_price disagree", discount.isNull() != original.isNull()),
        (f"discount outside 0-{MAX_DISCOUNT_PERCENT}",
         ~discount.between(0, MAX_DISCOUNT_PERCENT)),
    ]


def money_checks(variants: DataFrame, name: str = "variants") -> DataFrame:
    rules = money_rules()
    row = variants.agg(*(F.count_if(rule).alias(f"_r{i}") for i, (_, rule) in enumerate(rules)))
    return raised(row, [finding(ERROR, name, label, F.col(f"_r{i}"))
                        for i, (label, _) in enumerate(rules)])


def coverage_checks(staged_sites: DataFrame, processed_sites: DataFrame) -> DataFrame:
    """Sites that were staged and skipped (an error), or appear from nowhere.

    Both frames hold ``site``.
    """
    staged_sites = staged_sites.select(F.upper("site").alias("site"))
    sides = (set_difference(staged_sites, processed_sites, ["site"])
             .groupBy("side").agg(F.count(F.lit(1)).alias("_n"), F.min("site").alias("_s")))
    skipped = F.col("side") == "left_only"
    return sides.select(
        F.when(skipped, ERROR).otherwise(WARN).alias("level"),
        F.lit("coverage").alias("where"),
        F.when(skipped, "staged site missing from crawls")
        .otherwise("site in crawls, nothing staged").alias("check"),
        F.col("_n").alias("n"), F.col("_s").alias("sample"))


def processed_checks(tables: Mapping[str, DataFrame],
                     staged_sites: DataFrame | None = None) -> DataFrame:
    """Every check of the twelve tables; a table that is absent is skipped here."""
    frames = [table_checks(tables[n], n, spec) for n, spec in PROCESSED.items() if n in tables]
    for table, spec in PROCESSED.items():
        for column, vocabulary in spec.vocabularies.items():
            if table in tables and vocabulary in tables:
                frames.append(vocabulary_check(
                    tables[table], table, column, tables[vocabulary],
                    PROCESSED[vocabulary].grain[0], vocabulary))
    if "variants" in tables and "products" in tables:
        frames.append(orphan_check(tables["variants"], "variants", tables["products"],
                                   "products", ["product", "retailer"]))
    if "variants" in tables:
        frames.append(money_checks(tables["variants"]))
    if staged_sites is not None and "crawls" in tables:
        frames.append(coverage_checks(staged_sites, tables["crawls"].select("site")))
    return together(frames)
