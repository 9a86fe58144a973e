"""Every registered query against its SQL, and its plan against what does not scale."""

from __future__ import annotations

from pathlib import Path

import pytest

import __spark_entry__ as contract
from shelfmark.queries import REGISTERED

from . import oracle

FOLDER = Path("/root/testdata/sf0.001")
needs_data = pytest.mark.skipif(not FOLDER.is_dir(), reason="no test data")


@pytest.fixture(scope="module")
def connection():
    return oracle.connect(FOLDER)


@needs_data
@pytest.mark.parametrize("name", sorted(REGISTERED))
def test_query(spark, connection, name):
    registered = REGISTERED[name]
    assert registered.sql is not None
    _, problems = oracle.compare(spark, connection, FOLDER, name, registered)
    assert problems == []
    plan = registered.run(spark, str(FOLDER))._jdf.queryExecution().executedPlan().toString()
    for unwanted in ("CartesianProduct", "NestedLoopJoin", "PythonUDF", "ArrowEvalPython",
                     "MapInPandas", "BatchEvalPython"):
        assert unwanted not in plan


@needs_data
def test_contract(spark):
    assert set(REGISTERED) <= set(contract.queries())
    assert set(REGISTERED) <= set(contract.oracle_sql()) <= set(contract.queries())
    assert contract.entry(spark).columns == [
        "brand", "n_variants", "on_sale", "mean_discount", "total_price"]
