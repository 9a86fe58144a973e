"""Published statistics of the processed tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.profile import rate


def stock_by_product(variants: DataFrame,
                     grain: Sequence[str] = ("product", "retailer", "date")) -> DataFrame:
    """Per product observation: its variants, and whether some or all are in stock."""
    return variants.groupBy(*grain).agg(
        F.count(F.lit(1)).alias("n_variants"),
        F.bool_or("available").alias("some_in_stock"),
        F.bool_and("available").alias("all_in_stock"))


def stock_summary(variants: DataFrame,
                  grain: Sequence[str] = ("product", "retailer", "date")) -> DataFrame:
    """Products, the share of them partly in stock, and variants per product."""
    partly = F.col("some_in_stock") & ~F.col("all_in_stock")
    totals = stock_by_product(variants, grain).agg(
        F.count(F.lit(1)).alias("products"), F.sum("n_variants").alias("variants"),
        F.count_if(partly).alias("partly_in_stock"))
    per_product = F.round(F.col("variants") / F.nullif(F.col("products"), F.lit(0)), 2)
    return totals.select(
        "products", "variants", "partly_in_stock",
        rate(F.col("partly_in_stock"), F.col("products")).alias("partly_share"),
        per_product.cast("decimal(12,2)").alias("variants_per_product"))
