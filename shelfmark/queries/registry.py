"""How a query is registered, and how the given tables are read."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Registered:
    run: Query
    sql: str | None


REGISTERED: dict[str, Registered] = {}


def query(sql: str | None, name: str | None = None) -> Callable[[Query], Query]:
    """Register a function under its name or ``name``, with its SQL where there is any."""

    def register(function: Query) -> Query:
        key = name or function.__name__
        if key in REGISTERED:
            raise ValueError(f"{key} is registered twice")
        REGISTERED[key] = Registered(function, sql)
        return function

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def spread_table(spark: SparkSession, folder: str, name: str, *keys: str) -> DataFrame:
    """A table to compute much on, spread over the executors if its scan is not.

    A small file comes as one row group and so as one task. Only then are its rows
    redistributed; a table of more splits than cores is read as it lies.
    """
    frame = table(spark, folder, name)
    cores = spark.sparkContext.defaultParallelism
    if frame.rdd.getNumPartitions() >= cores:
        return frame
    return frame.repartition(cores, *keys)
