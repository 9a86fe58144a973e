"""Keeping costly expressions from being evaluated again and again."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def evaluated_once(frame: DataFrame, *columns: Column | str) -> DataFrame:
    """``select`` whose expressions are evaluated exactly once per row.

    The optimizer may inline a plain projection into all that uses it, a filter or an
    exploded row included, and evaluate it anew each time. The output of a generator is
    never inlined. The array is made by a projection of its own, which is compiled and evaluates
    what its expressions have in common once; within a generator they would be interpreted. It
    is never empty, and with the outer form no filter on its size is derived from it, which
    would evaluate it a second time.
    """
    return frame.select(F.array(F.struct(*columns)).alias("_row")).select(
        F.inline_outer("_row"))
