"""Intermediate tables in the shared folder that the cluster names."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` of the session; a folder of its own where it is unset.

    Only a local master may do without the setting, since other executors could not see
    a folder of this machine.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a shared folder on a cluster")
        folder = "file://" + tempfile.mkdtemp(prefix="shelfmark-llm-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def written(frame: DataFrame, name: str) -> DataFrame:
    """``frame`` as a Parquet table of the shared folder, which cuts its lineage."""
    spark, path = frame.sparkSession, new_folder(frame.sparkSession, name)
    frame.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def total_bytes(frame: DataFrame, column: str) -> int:
    """Bytes of a text or binary column, by which partition counts are chosen."""
    return frame.agg(F.sum(F.octet_length(column))).first()[0] or 0


def parts_for(size: int, per_part: int) -> int:
    return max(1, -(-size // per_part))


def packed(frame: DataFrame, *named: str) -> list[Column]:
    """The columns not named, as one struct ``rest`` that is carried along unread.

    An operator thus never confuses its own columns with extra ones of its input.
    """
    others = [c for c in frame.columns if c not in named]
    inner = [F.col(f"`{c}`") for c in others]
    return [F.struct(*inner).alias("rest")] if inner else [
        F.struct(F.lit(None).cast("int").alias("_")).alias("rest")]


def unpacked(source: DataFrame, *named: str) -> list[Column]:
    return [F.col("rest").getField(c).alias(c) for c in source.columns if c not in named]


def small_enough(keys: DataFrame, limit: int = 1_000_000) -> DataFrame:
    """Keys of a written table, to be broadcast if they are no more than ``limit``.

    Beyond it the frame has no hint and the join shuffles both sides.
    """
    return F.broadcast(keys) if keys.limit(limit + 1).count() <= limit else keys
