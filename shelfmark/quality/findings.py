"""Findings, and what a set of them means for a run."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..local import stated_rows

ERROR, WARN = "ERROR", "WARN"
FINDING = {"level": pa.string(), "where": pa.string(), "check": pa.string(), "n": pa.int64(),
           "sample": pa.string()}


class QualityError(RuntimeError):
    """At least one finding is an error."""


def finding(level: str, where: str | Column, check: str | Column, n: Column,
            sample: Column | None = None) -> Column:
    """One possible finding as a struct; it counts when ``n`` is above zero."""
    return F.struct(
        F.lit(level).alias("level"),
        (where if isinstance(where, Column) else F.lit(where)).alias("where"),
        (check if isinstance(check, Column) else F.lit(check)).alias("check"),
        n.cast("long").alias("n"),
        (F.lit(None) if sample is None else sample).cast("string").alias("sample"))


def raised(frame: DataFrame, candidates: Sequence[Column]) -> DataFrame:
    """The candidates of every row of ``frame`` that count."""
    return (frame.select(F.explode(F.array(*candidates)).alias("_f")).select("_f.*")
            .where(F.col("n") > 0))


def stated(spark: SparkSession, rows: Iterable[tuple]) -> DataFrame:
    """Findings known without looking at data: ``(level, where, check, n, sample)``."""
    return stated_rows(spark, FINDING, rows)


def together(frames: Iterable[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def summary(findings: DataFrame) -> DataFrame:
    return findings.groupBy("level").agg(F.count(F.lit(1)).alias("findings"))


def report(findings: DataFrame, subject: str, shown: int = 200) -> list[str]:
    """Findings as lines, errors first; raises when any is an error.

    Only the first ``shown`` lines are brought to the driver; the counts cover all.
    """
    counts = {r["level"]: r["findings"] for r in summary(findings).collect()}
    rows = findings.orderBy("level", "where", "check").limit(shown).collect()
    lines = [f"{r['level']} {r['where']}: {r['check']} ({r['n']})"
             + (f", e.g. {r['sample']}" if r["sample"] is not None else "") for r in rows]
    if counts.get(ERROR):
        raise QualityError("\n".join([
            f"{subject}: {counts[ERROR]} error(s), {counts.get(WARN, 0)} warning(s)", *lines]))
    return lines
