"""Surrogate keys: assigned once, never changed, the same on every attempt.

Rows are spread over buckets by a digest of their natural key, which is unique, so
buckets are even whatever the data looks like, and a lost executor recomputes the
same numbers. Nothing is sorted globally.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DIGEST_DIGITS = 3
BUCKETS = 16 ** DIGEST_DIGITS


def highest_key(table: DataFrame, key: str) -> Column:
    """The highest key a table holds, 0 for an empty one, as a scalar subquery."""
    return table.agg(F.coalesce(F.max(key), F.lit(0)).cast("long")).scalar()


def _bucket(natural: Sequence[str]) -> Column:
    text = F.concat_ws("|", *(F.coalesce(F.col(c).cast("string"), F.lit("")) for c in natural))
    return F.conv(F.substring(F.md5(text), 1, DIGEST_DIGITS), 16, 10).cast("long")


def dense_keys(rows: DataFrame, key: str, natural: Sequence[str],
               start: Column | int = 0, within: Sequence[str] = ()) -> DataFrame:
    """Keys ``start + 1 .. start + n``, for dimensions that are read by people.

    ``within`` names columns whose every value is numbered by itself. Reads ``rows`` twice:
    once for the number of rows per bucket (at most ``BUCKETS`` numbers each, hence
    the broadcast), once to number them.
    """
    start = F.lit(start) if isinstance(start, int) else start
    spread = rows.withColumn("_bucket", _bucket(natural))
    before = Window.partitionBy(*within).orderBy("_bucket").rowsBetween(
        Window.unboundedPreceding, -1)
    offsets = (
        rows.select(*within, _bucket(natural).alias("_bucket"))
        .groupBy(*within, "_bucket").agg(F.count(F.lit(1)).alias("_n"))
        .select(*within, "_bucket",
                F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    )
    inside = Window.partitionBy(*within, "_bucket").orderBy(*natural)
    return (
        spread.withColumn("_position", F.row_number().over(inside))
        .join(F.broadcast(offsets), [*within, "_bucket"])
        .select((start + F.col("_offset") + F.col("_position")).cast("long").alias(key),
                *rows.columns)
    )


def interleaved_keys(rows: DataFrame, key: str, natural: Sequence[str],
                     start: Column | int = 0) -> DataFrame:
    """Unique keys above ``start`` in one pass, with gaps.

    Bucket ``b`` takes every ``BUCKETS``-th number, so no bucket has to know how
    many rows the others hold. For tables with many rows.
    """
    start = F.lit(start) if isinstance(start, int) else start
    inside = Window.partitionBy("_bucket").orderBy(*natural)
    return (
        rows.withColumn("_bucket", _bucket(natural))
        .withColumn("_position", F.row_number().over(inside))
        .select((start + (F.col("_position") - 1) * BUCKETS + F.col("_bucket") + 1)
                .cast("long").alias(key), *rows.columns)
    )
