"""Session defaults and the shared folder used to cut lineage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Only semantics and adaptive execution are set here. Master, memory and the
# number of shuffle partitions belong to the cluster that runs the job.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a skewed join partition even where that costs one more exchange: one
    # product or retailer may hold a third of all rows.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def build_session(app_name: str = "shelfmark", **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The shared folder the cluster names, for tables of a run; a local one only where the
    master is local and none is named."""
    return (spark.conf.get("spark.checkpoint.dir", None) or _own_folder(spark)).rstrip("/")


def cut_lineage(frame: DataFrame) -> DataFrame:
    """``frame`` as a compressed table of the shared folder that the cluster names.

    A checkpoint of Spark would hold the rows as they are in memory, several times the size.
    """
    spark = frame.sparkSession
    context = spark.sparkContext
    if not context.getCheckpointDir():
        context.setCheckpointDir(shared_folder(spark))
    path = f"{context.getCheckpointDir()}/rows-{uuid.uuid4().hex}"
    frame.write.option("compression", "zstd").parquet(path)
    # Spark removes the shuffle files of what was written when the driver has forgotten its plan.
    context._jvm.System.gc()
    return spark.read.schema(frame.schema).parquet(path)


def _own_folder(spark: SparkSession) -> str:
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a shared folder on a cluster")
    return tempfile.mkdtemp(prefix="shelfmark-checkpoint-")
