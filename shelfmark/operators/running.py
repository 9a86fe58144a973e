"""Running sums over long sequences, without putting a sequence into one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BLOCK = 1024


def sum_before(frame: DataFrame, group: Sequence[str], position: str,
               value: Column, output: str, block: int = BLOCK) -> DataFrame:
    """Per group, the sum of ``value`` over all smaller positions.

    ``position`` is an integer, unique within the group. Each block of positions is
    summed by itself and the block totals are run up: of a sequence only one row per
    block meets in one task.
    """
    group = list(group)
    block_of = F.floor(F.col(position) / block).alias("_block")
    totals = (
        frame.select(*group, block_of, value.alias("_value"))
        .groupBy(*group, "_block").agg(F.sum("_value").alias("_total"))
    )
    earlier = (Window.partitionBy(*group).orderBy("_block")
               .rowsBetween(Window.unboundedPreceding, -1))
    offsets = totals.select(*group, "_block",
                            F.coalesce(F.sum("_total").over(earlier), F.lit(0)).alias("_offset"))
    inside = (Window.partitionBy(*group, "_block").orderBy(position)
              .rowsBetween(Window.unboundedPreceding, -1))
    return (
        frame.select("*", block_of, value.alias("_value"))
        .withColumn("_inside", F.coalesce(F.sum("_value").over(inside), F.lit(0)))
        .join(offsets, [*group, "_block"])
        .withColumn(output, F.col("_offset") + F.col("_inside"))
        .select(*frame.columns, output)
    )


def dense_position(frame: DataFrame, group: Sequence[str], position: str,
                   output: str) -> DataFrame:
    """0, 1, 2 ... per group in the order of ``position``, closing its gaps."""
    return sum_before(frame, group, position, F.lit(1).cast("long"), output)
