"""Connected components of a graph given by its edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.llm import folders


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``component`` (its smallest node) from edges ``a``, ``b``.

    Rounds of large and small stars: neighbours that are larger, then smaller, are hung on a
    node's smallest neighbour, until only stars around the smallest nodes are left. The
    number of rounds grows with the logarithm of the longest path; edges never multiply.
    Every round is a written table, so that a lost executor costs one round at most.
    """
    now = folders.written(
        edges.where("a <> b").select(F.greatest("a", "b").alias("a"),
                                     F.least("a", "b").alias("b")).distinct(), "edges")
    before = None
    while True:
        state = now.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast(
            "decimal(38,0)")).alias("digest")).first()
        if state == before or not state.n:
            break
        before = state
        now = folders.written(_small_star(_large_star(now)), "edges")
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select(
        "a", F.least("a", "m").alias("m"))
    larger = both.where("b > a").join(least, "a")
    return larger.select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")\
        .distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    smaller = edges.join(least, "a")
    return smaller.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))\
        .unionByName(least.select("a", F.col("m").alias("b"))).distinct()
