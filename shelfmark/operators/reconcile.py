"""Comparing two sets of things: sites, or the files of an upload."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def set_difference(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys only one side holds, with ``side`` saying which.

    Both sides are reduced to distinct keys before they meet, so repeated keys cost
    nothing in the shuffle. Null keys are compared like any other value.
    """
    keys = list(keys)
    tagged = (left.select(*keys, F.lit(1).alias("_l"), F.lit(0).alias("_r"))
              .unionByName(right.select(*keys, F.lit(0).alias("_l"), F.lit(1).alias("_r"))))
    return (
        tagged.groupBy(*keys).agg(F.max("_l").alias("_l"), F.max("_r").alias("_r"))
        .where(F.col("_l") != F.col("_r"))
        .select(*keys, F.when(F.col("_l") == 1, "left_only").otherwise("right_only")
                .alias("side"))
    )


def reconcile_datasets(local: DataFrame, held: DataFrame) -> DataFrame:
    """What an upload of datasets got wrong, one row per file.

    ``local`` and ``held`` are ``(dataset, file, size)``; a size that differs in a
    known way, such as padding, is put right in ``local`` beforehand. Outcomes:

    * ``missing``          on disk, not held
    * ``size_differs``     held with another size
    * ``nothing_held``     no file of a local dataset is held
    * ``stale``            held in a local dataset, not on disk: it would be loaded
    * ``orphan_dataset``   held, and the whole dataset is not on disk
    """
    datasets = (
        local.select("dataset", F.lit(1).alias("_l"), F.lit(0).alias("_h"))
        .unionByName(held.select("dataset", F.lit(0).alias("_l"), F.lit(1).alias("_h")))
        .groupBy("dataset")
        .agg((F.max("_l") == 1).alias("is_local"), (F.max("_h") == 1).alias("is_held"))
    )
    files = (
        local.select("dataset", "file", F.col("size").alias("local_size"))
        .join(held.select("dataset", "file", F.col("size").alias("held_size")),
              ["dataset", "file"], "full_outer")
        .join(datasets, "dataset")
    )
    outcome = (
        F.when(~F.col("is_local"), "orphan_dataset")
        .when(~F.col("is_held"), "nothing_held")
        .when(F.col("held_size").isNull(), "missing")
        .when(F.col("local_size").isNull(), "stale")
        .when(F.col("local_size") != F.col("held_size"), "size_differs")
    )
    return (files.withColumn("outcome", outcome).where(F.col("outcome").isNotNull())
            .select("dataset", "file", "local_size", "held_size", "outcome"))


def reconcile_crawl_files(local: DataFrame, held: DataFrame) -> DataFrame:
    """What an upload of raw crawl files got wrong, one row per file.

    ``local`` is ``(retailer, file, size)``, ``held`` is ``(file, path, size)``. A
    file has to lie under its retailer's prefix. Outcomes: ``missing``,
    ``size_differs``, ``wrong_prefix``, and ``earlier_crawl`` for what this crawl did
    not put there, which takes up room but is not loaded.
    """
    files = (
        local.select("file", "retailer", F.col("size").alias("local_size"))
        .join(held.select("file", "path", F.col("size").alias("held_size")),
              "file", "full_outer")
    )
    outcome = (
        F.when(F.col("held_size").isNull(), "missing")
        .when(F.col("local_size").isNull(), "earlier_crawl")
        .when(F.col("local_size") != F.col("held_size"), "size_differs")
        .when(~F.contains(F.col("path"), F.concat(F.lit("/"), "retailer", F.lit("/"))),
              "wrong_prefix")
    )
    return (files.withColumn("outcome", outcome).where(F.col("outcome").isNotNull())
            .select("retailer", "file", "path", "local_size", "held_size", "outcome"))
