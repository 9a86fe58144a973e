"""Merging a run into what earlier runs left, on plain files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def new_rows(target: DataFrame, source: DataFrame, keys: Sequence[str],
             within: tuple[str, Sequence] | None = None,
             held_within: tuple[str, Sequence] | None = None) -> DataFrame:
    """Source rows whose key the target does not hold.

    The insert-only merge is this, appended: nothing the target holds is read
    beyond its keys, and nothing is rewritten. ``within`` is a partition column among
    the keys and the values of it that the source has (``values_of``); being literals,
    they prune the target to those partitions when the query is planned. ``held_within``
    is the same of the target: source rows with other values are new without a join, and
    the source is read twice for that. A null in a key never matches.
    """
    held = target.select(*keys)
    if within:
        column, values = within
        held = held.where(F.col(column).isin([v for v in values if v is not None]))
    if held_within is None:
        return source.join(held, list(keys), "left_anti")
    column, values = held_within
    met = F.coalesce(F.col(column).isin([v for v in values if v is not None]), F.lit(False))
    return source.where(met).join(held, list(keys), "left_anti").select(
        *source.columns).unionByName(source.where(~met))


def values_of(frame: DataFrame, column: str) -> list:
    """The distinct values of a partition column: as many as a run touches partitions."""
    return [row[0] for row in frame.select(column).distinct().collect()]


def merge_insert_only(target: DataFrame, source: DataFrame, keys: Sequence[str],
                      within: tuple[str, Sequence] | None = None) -> DataFrame:
    """The target plus the source rows it does not hold: the first write wins."""
    return target.unionByName(new_rows(target, source, keys, within))


def merge_upsert(target: DataFrame, source: DataFrame, keys: Sequence[str],
                 updated: Sequence[str] | None = None) -> DataFrame:
    """Matched target rows take the source's values, unmatched source rows are added.

    ``updated`` limits what a match overwrites (default: all but the keys). Columns
    the source lacks, such as a surrogate key, stay as they are on a match and are
    null on an added row. Two source rows with one key fail the job, as they would
    fail a warehouse merge.
    """
    updated = set(source.columns if updated is None else updated) - set(keys)
    incoming = _one_row_per_key(source, keys, "_new")
    joined = target.withColumn("_old", F.lit(True)).join(incoming, list(keys), "full_outer")

    def merged(column: str):
        if column in keys or column not in source.columns:
            return F.col(column)
        taken = F.col("_new").isNotNull()
        if column not in updated:
            taken = taken & F.col("_old").isNull()
        return F.when(taken, F.col("_new")[column]).otherwise(F.col(column)).alias(column)

    return joined.select(*(merged(c) for c in target.columns))


def _one_row_per_key(source: DataFrame, keys: Sequence[str], packed: str) -> DataFrame:
    # Grouped on the merge keys, so the join that follows needs no other exchange.
    rest = F.struct(*(c for c in source.columns if c not in keys))
    grouped = source.groupBy(*keys).agg(F.first(rest).alias(packed),
                                        F.count(F.lit(1)).alias("_n"))
    single = F.when(F.col("_n") == 1, F.col(packed)).otherwise(
        F.raise_error(F.lit("merge source repeats a key: " + ", ".join(keys))))
    return grouped.select(*keys, single.alias(packed))
