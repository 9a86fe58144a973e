"""Largest-first reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .dedupe import top_per_key


def largest(frame: DataFrame, by: str, tie: str, top: int) -> DataFrame:
    """The ``top`` rows by ``by``, ties by ``tie``."""
    return frame.orderBy(F.desc(by), tie).limit(top)


def largest_per_group(frame: DataFrame, group: Sequence[str], by: str, tie: str,
                      top: int, rank: str = "rank") -> DataFrame:
    """The ``top`` rows of every group, numbered."""
    return top_per_key(frame, group, [F.desc(by), F.col(tie)], top, rank)


def beyond_largest(frame: DataFrame, group: Sequence[str], by: str, tie: str,
                   top: int, total: str = "tail_total") -> DataFrame:
    """Per group, the sum of ``by`` over all rows past its ``top`` largest.

    The whole group is never ranked: its total less that of its ``top`` rows.
    """
    group = list(group)
    head = (largest_per_group(frame, group, by, tie, top)
            .groupBy(*group).agg(F.sum(by).alias("_head")))
    return (
        frame.groupBy(*group).agg(F.sum(by).alias("_all"), F.count(F.lit(1)).alias("_n"))
        .join(head, group)
        .select(*group, F.greatest(F.col("_n") - top, F.lit(0)).alias("tail_rows"),
                (F.col("_all") - F.col("_head")).alias(total))
    )
