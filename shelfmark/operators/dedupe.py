"""Keeping one row per key, always the same one."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def first_per_key(frame: DataFrame, keys: Sequence[str],
                  order: Sequence[Column | str]) -> DataFrame:
    """One row per ``keys``: the first by ``order``.

    Every remaining sortable column breaks ties, so the kept row does not depend on how
    the input was partitioned. Filtering ``row_number() = 1`` lets Spark cut each
    key to one row in every task before the shuffle, so a key that holds a large
    share of the rows sends one row per task and not its whole group.
    """
    return top_per_key(frame, keys, order, 1)


def top_per_key(frame: DataFrame, keys: Sequence[str],
                order: Sequence[Column | str], count: int,
                rank: str | None = None) -> DataFrame:
    """The first ``count`` rows per ``keys`` by ``order``, made total."""
    window = Window.partitionBy(*keys).orderBy(*_total_order(frame, keys, order))
    ranked = frame.withColumn(rank or "_rank", F.row_number().over(window))
    kept = ranked.where(F.col(rank or "_rank") <= count)
    return kept if rank else kept.drop("_rank")


def _total_order(frame: DataFrame, keys: Sequence[str],
                 order: Sequence[Column | str]) -> list[Column]:
    named = {o for o in order if isinstance(o, str)}
    rest = [f.name for f in frame.schema
            if f.name not in named and f.name not in keys and _sortable(f.dataType)]
    return [F.col(o) if isinstance(o, str) else o for o in order] + [F.col(c) for c in rest]


def _sortable(kind: T.DataType) -> bool:
    if isinstance(kind, T.ArrayType):
        return _sortable(kind.elementType)
    if isinstance(kind, T.StructType):
        return all(_sortable(f.dataType) for f in kind.fields)
    return not isinstance(kind, (T.MapType, T.VariantType))
