"""Stored tables: Parquet folders below a root, one per table and load.

``<root>/<table>/load=<id>/`` holds what a load wrote, ``<root>/loads/load=<id>/`` which
tables that were and how, as one small file written last. A load is seen once that file
is there; the folders of one that failed, or of another under way at the same time, are
read by nobody. Ids are unique by themselves and in the order of their beginning, so
no load ever takes another's folder. Appending a crawl rewrites nothing, and a table
can be replaced while it is read.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions.stamps import dataset_of
from ..local import empty_frame, stated_rows

APPEND, REPLACE = "append", "replace"
_WRITTEN = {"table": pa.string(), "mode": pa.string(), "n_rows": pa.int64(),
            "schema": pa.string()}


class TableMissing(LookupError):
    """No load holds the table."""


def _there(frame):
    """What ``frame`` reads, or nothing where its path is not there; other faults are raised."""
    try:
        return frame()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


@dataclass(frozen=True)
class TableStore:
    """The tables under ``root``."""

    spark: SparkSession
    root: str

    def loads(self) -> DataFrame:
        """``table, mode, n_rows, schema, load``: what every finished load wrote."""
        found = _there(lambda: self.spark.read.schema(
            "table string, mode string, n_rows bigint, schema string, load string").json(
            f"{self.root}/loads"))
        return empty_frame(self.spark, "table string, mode string, n_rows bigint, "
                           "schema string, load string") if found is None else found

    def _parts(self, table: str) -> list:
        """The writes of a table that count: from the last replacement on."""
        mine = self.loads().where(F.col("table") == table)
        last = mine.where(F.col("mode") == REPLACE).agg(F.max("load")).scalar()
        return mine.where(F.col("load") >= F.coalesce(last, F.lit(""))).orderBy(
            "load").collect()

    def tables(self) -> set[str]:
        return {row[0] for row in self.loads().select("table").distinct().collect()}

    def read(self, table: str, load: str | None = None) -> DataFrame:
        """A table as it is now, or only the rows that one load wrote."""
        parts = [p for p in self._parts(table) if load in (None, p["load"])]
        if not parts:
            raise TableMissing(f"{self.root}/{table}")
        return self._folders(table, parts[-1]["schema"], [p["load"] for p in parts])

    def _folders(self, table: str, schema: str, loads: list[str]) -> DataFrame:
        # The schema is the one stated, so no footer is read to plan a query.
        return (self.spark.read.schema(f"{schema}, load string")
                .option("basePath", f"{self.root}/{table}")
                .parquet(*(f"{self.root}/{table}/load={x}" for x in loads)).drop("load"))

    def read_or_empty(self, table: str, schema: str) -> DataFrame:
        try:
            return self.read(table)
        except TableMissing:
            return empty_frame(self.spark, schema)

    def highest(self, table: str, column: str) -> int:
        """The highest value of a column by the footers of its files; 0 for no rows.

        A session of its own reads the folders as a source that answers ``max`` from the
        footers' statistics: no column of the history is read.
        """
        parts = self._parts(table)
        if not parts:
            return 0
        return footer_max(self.spark, f"{self.root}/{table}", [p["load"] for p in parts],
                          parts[-1]["schema"], column).first()[0] or 0

    def counts(self) -> DataFrame:
        """``table, load, mode, n_rows`` of every write."""
        return self.loads().select("table", "load", "mode", "n_rows")

    def begin(self) -> Load:
        # Nanoseconds as digits of one length: ids are in the order of their beginning.
        return Load(self, f"{time.time_ns():019d}-{uuid.uuid4().hex[:8]}")

    def check_present(self, expected: Iterable[str]) -> list[tuple[str, str, str]]:
        """Missing and unexpected tables as ``(level, where, message)``."""
        held, expected = self.tables(), set(expected)
        return ([("ERROR", t, "no finished load holds the table")
                 for t in sorted(expected - held)]
                + [("WARN", t, "unexpected table") for t in sorted(held - expected)])


def footer_max(spark: SparkSession, table: str, loads: list[str], schema: str,
               column: str) -> DataFrame:
    """One row with the highest value of a column of some loads, from their footers."""
    session = spark.newSession()
    session.conf.set("spark.sql.sources.useV1SourceList", "")
    session.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    return (session.read.schema(f"{schema}, load string").option("basePath", table)
            .parquet(*(f"{table}/load={x}" for x in loads)).agg(F.max(column)))


@dataclass
class Load:
    """Writes that are seen together, or not at all."""

    store: TableStore
    number: str
    written: list[tuple[str, str, int, str]] = field(default_factory=list)
    observed: dict[str, dict] = field(default_factory=dict)

    def write(self, table: str, frame: DataFrame, mode: str = REPLACE, *,
              partition_by: str | None = None, files: int | None = None,
              measures: Mapping[str, Column] | None = None) -> int:
        """Write ``frame`` as this load's part of ``table``; returns the rows written.

        The rows are counted while they are written, so the plan runs once; so are other
        ``measures``, which ``observed`` then has by table.
        """
        if files:
            frame = frame.coalesce(files)
        counted = Observation()
        writer = frame.observe(counted, F.count(F.lit(1)).alias("n"), *(
            m.alias(name) for name, m in (measures or {}).items())).write.mode("overwrite")
        if partition_by:
            writer = writer.partitionBy(partition_by)
        writer.parquet(f"{self.store.root}/{table}/load={self.number}")
        schema = ", ".join(f"`{c.name}` {c.dataType.simpleString()}" for c in frame.schema)
        self.observed[table] = {name: counted.get[name] for name in measures or {}}
        self.written.append((table, mode, counted.get["n"], schema))
        return counted.get["n"]

    def pending(self, table: str) -> DataFrame:
        """The table as it will read once this load is finished."""
        _, mode, _, schema = next(w for w in reversed(self.written) if w[0] == table)
        mine = self.store._folders(table, schema, [self.number])
        if mode == REPLACE or table not in self.store.tables():
            return mine
        return self.store.read(table).unionByName(mine)

    def commit(self) -> None:
        rows = stated_rows(self.store.spark, _WRITTEN, self.written)
        (rows.coalesce(1).write.mode("overwrite")
         .json(f"{self.store.root}/loads/load={self.number}"))


def dataset_files(files: DataFrame) -> DataFrame:
    """``dataset, files`` from a listing with ``file_path``: parts per dataset folder."""
    return (files.groupBy(dataset_of(F.col("file_path")).alias("dataset"))
            .agg(F.count(F.lit(1)).alias("files")))
