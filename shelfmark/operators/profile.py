"""Fill rates and distinct counts of a table's columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

RATE = "decimal(5,4)"


def rate(part: Column, whole: Column) -> Column:
    """A share with four digits; null of nothing."""
    return F.round(part / F.nullif(whole, F.lit(0)), 4).cast(RATE)


def unpivot_row(row: DataFrame, columns: Sequence[str], **measures: str) -> DataFrame:
    """One row per column from a one-row aggregate named ``<prefix><column>``."""
    structs = [
        F.struct(F.lit(c).alias("column"),
                 *(F.col(prefix + c).alias(name) for name, prefix in measures.items()))
        for c in columns
    ]
    kept = [c for c in row.columns
            if not any(c == p + n for p in measures.values() for n in columns)]
    return row.select(*kept, F.explode(F.array(*structs)).alias("_one")).select(*kept, "_one.*")


def fill_rates(frame: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """``column, n_rows, filled, fill_rate`` of every column, in one pass."""
    columns = list(columns or frame.columns)
    row = frame.agg(F.count(F.lit(1)).alias("n_rows"),
                    *(F.count(c).alias(f"_filled_{c}") for c in columns))
    return unpivot_row(row, columns, filled="_filled_").select(
        "column", "n_rows", "filled", rate(F.col("filled"), F.col("n_rows")).alias("fill_rate"))


def profile(frame: DataFrame, columns: Sequence[str] | None = None, *,
            approximate: bool = False) -> DataFrame:
    """``fill_rates`` and the number of distinct values.

    Exact counts go through one row per distinct value of each column; for a whole
    lake ``approximate=True`` keeps one small sketch per task instead.
    """
    columns = list(columns or frame.columns)
    if approximate:
        row = frame.agg(F.count(F.lit(1)).alias("n_rows"),
                        *(F.count(c).alias(f"_filled_{c}") for c in columns),
                        *(F.approx_count_distinct(c).alias(f"_distinct_{c}") for c in columns))
        profiled = unpivot_row(row, columns, filled="_filled_", distinct="_distinct_")
        return profiled.select("column", "n_rows", "filled",
                               rate(F.col("filled"), F.col("n_rows")).alias("fill_rate"),
                               F.col("distinct").alias("n_distinct"))
    values = frame.select(F.explode(F.array(*(
        F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value"))
        for c in columns))).alias("_v")).select("_v.*")
    # One row per distinct value and column before anything is counted across tasks.
    counted = values.groupBy("column", "value").agg(F.count(F.lit(1)).alias("_n"))
    return (
        counted.groupBy("column").agg(
            F.sum("_n").alias("n_rows"),
            F.coalesce(F.sum(F.when(F.col("value").isNotNull(), F.col("_n"))), F.lit(0))
            .alias("filled"),
            F.count("value").alias("n_distinct"))
        .select("column", "n_rows", "filled",
                rate(F.col("filled"), F.col("n_rows")).alias("fill_rate"), "n_distinct")
    )


SKETCH_BITS = 12        # 2 ** 12 registers: a standard error of 1.04 / 64
STANDARD_ERROR = 1.04 / 2 ** (SKETCH_BITS / 2)


def sketches(frame: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``column, n_rows, filled, sketch``: a load's profile that adds up with others.

    The sketch of a column (a few KB, whatever the rows) is kept with the load; distinct
    counts over many loads then read sketches and no rows.
    """
    text = {c: F.col(c).cast("string") for c in columns}
    row = frame.agg(F.count(F.lit(1)).alias("n_rows"),
                    *(F.count(c).alias(f"_filled_{c}") for c in columns),
                    *(F.hll_sketch_agg(x, F.lit(SKETCH_BITS)).alias(f"_sketch_{c}")
                      for c, x in text.items()))
    return unpivot_row(row, columns, filled="_filled_", sketch="_sketch_").select(
        "column", "n_rows", "filled", "sketch")


def united(profiles: DataFrame) -> DataFrame:
    """``profile`` of all loads together out of their ``sketches``, distinct counts estimated."""
    return profiles.groupBy("column").agg(
        F.sum("n_rows").alias("n_rows"), F.sum("filled").alias("filled"),
        F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("n_distinct")).select(
        "column", "n_rows", "filled", rate(F.col("filled"), F.col("n_rows")).alias("fill_rate"),
        "n_distinct")
