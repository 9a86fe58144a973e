"""Running a registered query and its SQL side by side.

    python -m tests.oracle /root/testdata/sf0.01 [query ...]
"""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb


def connect(folder):
    connection = duckdb.connect()
    for path in sorted(Path(folder).glob("*.parquet")):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


def canonical(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(repr(row[i]) for i in order) for row in rows)


def compare(spark, connection, folder, name, registered):
    """A description of every difference; empty when they agree."""
    frame = registered.run(spark, str(folder))
    got = canonical(frame.collect(), frame.columns)
    result = connection.execute(registered.sql)
    columns = [d[0] for d in result.description]
    types = {d[0]: str(d[1]) for d in result.description}
    want = canonical(result.fetchall(), columns)
    problems = []
    if sorted(columns) != sorted(frame.columns):
        problems.append(f"columns {sorted(frame.columns)} want {sorted(columns)}")
    if len(got) != len(want):
        problems.append(f"{len(got)} rows, want {len(want)}")
    if got != want:
        extra, lacking = set(got) - set(want), set(want) - set(got)
        problems.append(f"{len(extra)} unexpected, {len(lacking)} missing")
        problems += [f"  got  {r}" for r in sorted(extra)[:3]]
        problems += [f"  want {r}" for r in sorted(lacking)[:3]]
    plain = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "date": "DATE",
             "boolean": "BOOLEAN", "double": "DOUBLE"}
    for field in frame.schema:
        kind = field.dataType.simpleString()
        wanted = plain.get(kind, kind.upper())
        if field.name in types and types[field.name].replace(" ", "") != wanted:
            problems.append(f"type of {field.name}: {kind}, SQL has {types[field.name]}")
    return len(got), problems


def main(folder, names):
    from shelfmark.queries import REGISTERED
    from shelfmark.session import build_session

    spark = build_session("oracle", **{
        "spark.master": "local[8]", "spark.sql.shuffle.partitions": "8",
        "spark.ui.enabled": "false", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    connection, failed = connect(folder), 0
    for name, registered in REGISTERED.items():
        if names and name not in names:
            continue
        started = time.time()
        if registered.sql is None:
            n, problems = registered.run(spark, folder).count(), []
        else:
            try:
                n, problems = compare(spark, connection, folder, name, registered)
            except Exception as error:  # noqa: BLE001 - every query is reported
                n, problems = -1, [str(error)[:1500]]
        failed += bool(problems)
        print(f"{'FAIL' if problems else 'ok':5}{name:32}{n:>9} {time.time() - started:6.1f}s",
              flush=True)
        for problem in problems:
            print("     ", problem)
    print(f"{failed} failed")
    return failed


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1], sys.argv[2:]) else 0)
