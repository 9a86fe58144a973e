"""What costly expressions cost: evaluated once, by a projection, for the rows that need them."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from shelfmark.operators.expressions import evaluated_once
from shelfmark.operators import lookup
from shelfmark.quality import raw as checks
from shelfmark.queries import REGISTERED, documents, model
from shelfmark.session import cut_lineage
from shelfmark.sources import pieces, raw


def test_costly_expressions_stand_in_a_projection(spark):
    costly = F.transform(F.sequence(F.lit(0), F.col("id")), lambda x: x * 2).alias("a")
    frame = evaluated_once(spark.range(3), costly).where(F.size("a") > 1)
    lines = frame._jdf.queryExecution().optimizedPlan().toString().splitlines()
    assert sum("transform" in line for line in lines) == 1
    assert not any("transform" in line for line in lines if "Generate" in line)
    assert sorted(r["a"] for r in frame.collect()) == [[0, 2], [0, 2, 4]]


def test_fields_of_an_object_stand_on_lines_of_their_own(spark):
    title = 'a,"vendor": "b",\\"tags":'
    row = spark.range(1).select(F.struct(
        F.lit(None).cast("string").alias("id"), F.lit(title).alias("title"),
        F.lit("vendor").alias("vendor"), F.array(F.lit("tags"), F.lit(",")).alias("tags"),
        F.array(F.struct(F.lit("v").alias("id"))).alias("variants")).alias("s"))
    text = row.select(documents._object(
        F.col("s"), ["id", "title", "vendor", "tags", "variants"])).first()[0]
    assert [line.split(":")[0].strip() for line in text.split("\n")] == [
        "{", '"title"', '"vendor"', '"tags"', '"variants"', "}"]
    assert json.loads(text) == {"title": title, "vendor": "vendor", "tags": ["tags", ","],
                                "variants": [{"id": "v"}]}


@pytest.fixture
def folder(spark, tmp_path):
    spark.createDataFrame(
        [(i, f"Some words, of \"{i}\"\nand a line more", 30) for i in (1, 17, 31, 37)],
        "doc_id bigint, text string, n_chars bigint").write.parquet(
        str(tmp_path / "documents.parquet"))
    return str(tmp_path)


def test_whole_texts_are_told_for_odd_files_alone(spark, folder):
    found = REGISTERED["raw_structure_check"].run(spark, folder)
    assert {r["check"] for r in found.collect()} == {
        "complete is missing", "invalid JSON", "root is not an object"}
    assert "LeftSemi" in found._jdf.queryExecution().optimizedPlan().toString()


def test_pieces_are_not_joined(spark, folder):
    texts = documents.document_texts(spark, folder, spark.createDataFrame(
        [("store-1-20240131T091402Z.json",), (None,)], "file_path string"))
    assert [r["file_path"] for r in texts.collect()] == ["store-1-20240131T091402Z.json"]


def test_a_value_is_folded_once_for_an_allowlist(spark, vocabularies):
    rows = spark.createDataFrame([("YSL",), ("x",), (None,)], "vendor string")
    kept = lookup.resolve(rows, brand=("vendor", vocabularies["brands"])).where(
        F.col("brand").isNotNull())
    assert [r["brand"] for r in kept.collect()] == ["SAINT LAURENT"]
    plan = kept._jdf.queryExecution().optimizedPlan().toString()
    assert sum("regexp_replace" in line for line in plan.splitlines()) == 1


def test_pieces_are_told_once_for_all_checks(spark, folder, monkeypatch):
    told, whole = [], documents.document_texts
    monkeypatch.setattr(documents, "document_texts", lambda *a: told.append(a) or whole(*a))
    found = REGISTERED["raw_split_checks"].run(spark, folder).count()
    assert found and len(told) == 1
    marked = pieces.marked(pieces.cut_text(whole(spark, folder)))
    files = pieces.summary(marked)
    one, two = raw.parts_at_once(marked), raw.parts_of_pieces(marked, files.where("NOT odd"))
    line = lambda frame: sorted(map(str, frame.collect()))
    assert line(one.tops.select("file")) == line(two.tops.select("file"))
    assert line(one.rows) == line(two.rows)


def test_rows_of_documents_are_counted_in_one_pass(spark):
    e = lambda **held: tuple(held.get(n) for n in raw.CHECKED_FIELDS)
    rows = spark.createDataFrame([
        ("f", "products", "a", None, e(id="a", vendor="v")), ("f", "products", "b", None, None),
        ("f", "products", "b", None, e(id="x", vendor="")), ("f", "vendors", "v", 2, None),
        ("f", "vendors", "w", None, None), ("f", "responses", None, None, e(
            count=3, product_ids=["a", "c", None])), ("f", "responses", None, None, e()),
        ("f", "listings", None, None, e(label="c0", stopped_reason="error", short_pages=[1, 2])),
        ("f", "listings", None, None, e(label="*unfiltered*", stopped_reason="empty_page")),
        ("f", "listings", None, None, None), ("f", "errors", None, None, e(page=4, error="late")),
        ("f", "errors", None, None, e(page=2, error="z")), ("g", "vendors", None, 1, None)],
        f"file string, container string, key string, number bigint, e {raw.CHECKED}")
    held = checks.held_numbers(rows)
    plan = held._jdf.queryExecution().optimizedPlan().toString()
    assert sum("LogicalRDD" in line or "LocalRelation" in line for line in plan.splitlines()) == 1
    got = {r["file"]: r.asDict() for r in held.collect()}
    assert got["f"] == {
        "file": "f", "products_stored": 3, "products_received": 3, "pages": 2, "short_pages": 2,
        "collections_crawled": 2, "foreign": 2, "listings": 3, "cut": 2, "failed": 2,
        "why": "error", "first_error": "z", "bodiless": 1, "untraced": 1, "off_vendors": 1,
        "off_vendor": "v"}
    assert got["g"]["pages"] == 0 and got["g"]["why"] == "" and got["g"]["off_vendor"] is None


def test_products_of_two_loads_are_described_once(spark, monkeypatch):
    cut = []
    monkeypatch.setattr(model, "cut_lineage", lambda f: cut.append(f) or cut_lineage(f))
    REGISTERED["dim_product_snapshot"].run(spark, "/root/testdata/sf0.001")
    assert any("color" in frame.columns for frame in cut)


def test_ids_of_a_page_are_not_shuffled_one_by_one(spark, tmp_path):
    spark.createDataFrame(
        [(1, "a b a\nb c", 9), (1, "d a", 3), (2, "a a", 3), (3, None, None)],
        "doc_id bigint, text string, n_chars bigint").repartition(3).write.parquet(
        str(tmp_path / "documents.parquet"))
    found = REGISTERED["page_first_delivery"].run(spark, str(tmp_path))
    plan = found._jdf.queryExecution().executedPlan().toString()
    dealt = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert dealt and not any("product_id" in line for line in dealt)
    got = sorted((r.site, r.product_id, r.seq, r.pos) for r in found.collect())
    assert [g[:2] for g in got] == [
        ("store-1", "a"), ("store-1", "b"), ("store-1", "c"), ("store-1", "d"), ("store-2", "a")]
    assert got[4][2:] == (0, 0) and got[2][2:] == (1, 1)
