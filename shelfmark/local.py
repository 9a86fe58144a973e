"""Small frames the driver states itself."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession


def stated_rows(spark: SparkSession, columns: Mapping[str, pa.DataType] | Sequence[str],
                rows: Iterable[Sequence]) -> DataFrame:
    """A frame of literal rows; columns are text unless a type is given.

    Handed over as an Arrow table it becomes a local relation: the optimizer knows its
    exact size and evaluates projections over it without a job.
    """
    types = columns if isinstance(columns, Mapping) else dict.fromkeys(columns, pa.string())
    rows = list(rows)
    return spark.createDataFrame(pa.table({
        name: pa.array([row[i] for row in rows], kind)
        for i, (name, kind) in enumerate(types.items())}))


def empty_frame(spark: SparkSession, ddl: str) -> DataFrame:
    """No rows of the given schema, known to the optimizer to be none."""
    return spark.createDataFrame([], ddl).limit(0)
