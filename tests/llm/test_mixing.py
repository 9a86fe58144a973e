from __future__ import annotations

from pathlib import Path

import pytest

from shelfmark.llm import mixing
from tests import oracle

FOLDER = Path("/root/testdata/sf0.001")


def test_margins_are_met(spark):
    rows = [(s, g, t, float(m)) for (s, g, t), m in zip(
        [(s, g, t) for s in ("a", "b", None) for g in ("x", "y") for t in ("p", "q")],
        [50, 10, 30, 5, 5, 1, 9, 40, 3, 3, 8, 2], strict=True)]
    cells = spark.createDataFrame(rows, "source string, lang string, topic string, mass double")
    targets = {"source": {"a": 0.5, "b": 0.5}, "lang": {"x": 1, "y": 3}}
    got = mixing.raked(cells, targets, rounds=16, temper=1.0).collect()
    total = sum(r.fitted for r in got)
    share = lambda c, v: sum(r.fitted for r in got if r[c] == v) / total
    assert total == pytest.approx(166.0)
    assert share("source", "a") == pytest.approx(0.5) and share("source", None) == 0
    assert share("lang", "x") == pytest.approx(0.25)
    assert share("topic", "p") == pytest.approx(105 / 166)


def test_shares_to_the_power_of_one_draw_everything(spark):
    docs = spark.createDataFrame(
        [(i, "t" * (i % 7), "s" if i % 3 else None, None if i % 2 else "en", i)
         for i in range(60)] + [(None, None, None, None, None)],
        "doc_id bigint, text string, source string, lang string, topic int")
    told = mixing.probabilities(mixing.described(docs), temper=1.0)
    assert {r.probability for r in told.collect()} == {1.0} and told.count() == 61
    kept = mixing.mixed(docs)
    assert kept.columns == docs.columns and 0 < kept.count() <= 61
    assert mixing.mixed(docs.limit(0)).collect() == []


def test_no_python_on_the_executors(spark):
    plan = mixing.mixing(spark.read.parquet(f"{FOLDER}/documents.parquet"))._jdf.queryExecution(
        ).executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan


@pytest.mark.skipif(not FOLDER.is_dir(), reason="no test data")
def test_against_sql(spark):
    class Registered:
        sql = mixing.mixing_sql()
        run = staticmethod(lambda s, f: mixing.mixing(s.read.parquet(f"{f}/documents.parquet")))

    n, problems = oracle.compare(spark, oracle.connect(FOLDER), FOLDER, "op4", Registered)
    assert n and problems == []


def test_a_stray_row_does_not_scale_down_the_rest(spark):
    rows = [(i, "word " * 100, f"s{i % 3}" if i % 7 else "s0", "en" if i % 5 else "fr")
            for i in range(300)]
    schema = "doc_id bigint, text string, source string, lang string"
    expected = []
    for extra in ([], [(999, "x" * 40, "stray", None)]):
        docs = mixing.described(spark.createDataFrame(rows + extra, schema))
        got = mixing.budgeted_probabilities(docs).collect()
        assert len(got) == len(rows + extra) and all(r.probability <= 1 for r in got)
        tokens = sum(r.n_tokens for r in got)
        assert sum(r.n_tokens * r.probability for r in got) == pytest.approx(
            mixing.BUDGET * tokens, rel=1e-4)
        expected.append({r.id: r.probability for r in got if r.id != 999})
    assert expected[1] == pytest.approx(expected[0], abs=0.01)
    assert {r.probability for r in got if r.id == 999} == {1.0}


def test_short_cells_stay_whole_and_others_meet_their_goals(spark):
    cells = spark.createDataFrame(
        [("a", "x", "p", 10.0), ("b", "x", "p", 500.0), ("c", "x", "p", 490.0)],
        "source string, lang string, topic string, mass double")
    got = {r.source: r.fitted for r in mixing.budgeted(
        cells, {"source": {"a": 2, "b": 1, "c": 1}}, budget=0.5).collect()}
    assert got == pytest.approx({"a": 10.0, "b": 245.0, "c": 245.0})
