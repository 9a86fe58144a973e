from __future__ import annotations

import json

import pytest

from shelfmark import vocabularies as voc
from shelfmark.operators import lookup
from shelfmark.plans import conform

from .conftest import BRANDS, CATEGORIES


def test_fixed_vocabularies_have_the_documented_sizes(vocabularies):
    sizes = {name: len(v.rows) for name, v in vocabularies.items()}
    assert {k: sizes[k] for k in ("genders", "countries", "currencies")} == {
        "genders": 4, "countries": 12, "currencies": 4}
    assert len(voc.SEGMENTS) == 10 and len(voc.TIERS) == 4


def test_canonical_value_is_its_own_spelling(vocabularies):
    assert vocabularies["brands"].lookup["saintlaurent"] == "SAINT LAURENT"
    assert vocabularies["brands"].lookup["ysl"] == "SAINT LAURENT"
    assert vocabularies["countries"].lookup["italia"] == "IT"


def test_later_definition_has_a_shared_spelling(vocabularies):
    categories = vocabularies["categories"]
    assert categories.lookup["polos"] == "TOPS"
    assert categories.collisions == (("polos", "T-SHIRTS", "TOPS"),)
    assert lookup.collision_findings(vocabularies)[0][:2] == ("WARN", "categories")


def test_attributes(spark, vocabularies):
    rows = {r["code"]: r["name"] for r in vocabularies["countries"].table(spark).collect()}
    assert rows["GB"] == "UNITED KINGDOM"
    bare = voc.build_vocabulary(spark, "x", {"a": None}, attributes=("note",))
    assert bare.rows == [{"name": "A", "note": None}]
    with pytest.raises(voc.VocabularyError):
        voc.build_vocabulary(spark, "x", {"a": {}}, attributes=("name",))


def test_brand_rules(spark):
    segments = voc.build_vocabulary(spark, "segments", ["Designer"])
    tiers = voc.build_vocabulary(spark, "tiers", ["Luxury"])
    for brands in ({"A": {"segment": "Designr", "tier": "Luxury"}},
                   {"A": {"segment": "Designer"}}, {True: {}}):
        with pytest.raises(voc.VocabularyError):
            voc.build_brands(spark, brands, segments, tiers)


def test_definition_files(tmp_path, spark):
    path = tmp_path / "brands.json"
    path.write_text(json.dumps(BRANDS))
    assert voc.read_definition(path) == BRANDS
    loaded = voc.load_vocabularies(spark, voc.read_definition(path), CATEGORIES)
    assert len(loaded["brands"].rows) == 4
    yaml = pytest.importorskip("yaml")
    path = tmp_path / "brands.yaml"
    path.write_text(yaml.safe_dump(BRANDS))
    assert voc.read_definition(path) == BRANDS


def test_resolve(spark, vocabularies):
    frame = spark.createDataFrame([("ysl", 1), ("ALAIA", 2), ("nobody", 3), (None, 4)],
                                  "vendor string, n int")
    rows = lookup.resolve(frame, brand=("vendor", vocabularies["brands"])).orderBy("n").collect()
    assert [r["brand"] for r in rows] == ["SAINT LAURENT", "ALAÏA", None, None]
    empty = voc.Vocabulary("none", [], {})
    assert lookup.resolve(frame, brand=("vendor", empty)).where("brand is null").count() == 4


def test_resolve_with_a_vocabulary_table(spark, vocabularies):
    table = vocabularies["brands"].spellings(spark)
    frame = spark.createDataFrame([("acne",)], "vendor string")
    assert lookup.resolve(frame, b=("vendor", table)).first()["b"] == "ACNE STUDIOS"


def test_first_resolved(spark, vocabularies):
    frame = spark.createDataFrame([("x", "ysl"), ("acne", "ysl"), ("x", None)], "a string, b string")
    rows = lookup.first_resolved(frame, "brand", ["a", "b"], vocabularies["brands"])
    assert sorted(str(r["brand"]) for r in rows.collect()) == [
        "ACNE STUDIOS", "None", "SAINT LAURENT"]
    assert rows.columns == ["a", "b", "brand"]


def test_resolve_arrays_agrees_with_one_of(spark, vocabularies):
    from shelfmark.functions import one_of
    from pyspark.sql import functions as F

    frame = spark.createDataFrame(
        [(1, ["mens", "x"]), (2, ["mens", "Ladies"]), (3, ["x"]), (4, None), (5, ["Boys", "Girl", "Girls"])],
        "k int, v array<string>")
    genders = vocabularies["genders"]
    joined = lookup.resolve_arrays(frame, ["k"], "v", "g", genders, "UNISEX")
    direct = frame.select("k", one_of(F.col("v"), genders.lookup, "UNISEX").alias("g"))
    assert ({(r["k"], r["g"]) for r in joined.collect()}
            == {(r["k"], r["g"]) for r in direct.collect()})


def test_unmatched(spark, vocabularies):
    frame = spark.createDataFrame(
        [("b",), ("b ",), ("a",), ("c",), ("YSL",), ("",), (None,)], "vendor string")
    brands = vocabularies["brands"]
    assert [tuple(r) for r in lookup.unmatched(frame, "vendor", brands).collect()] == [
        ("b", 2), ("a", 1), ("c", 1)]
    assert lookup.unmatched_preview(frame, "vendor", brands, 2) == ([("b", 2), ("a", 1)], True)
    assert lookup.unmatched_preview(frame, "vendor", brands, 3)[1] is False


def test_sync(spark):
    held = spark.createDataFrame([("A", "old"), ("GONE", "x")], "name string, tier string")
    current = spark.createDataFrame([("A", "new", "s"), ("B", "t", "s")],
                                    "name string, tier string, segment string")
    rows = {tuple(r) for r in conform.sync_vocabulary(held, current, "name").collect()}
    assert rows == {("A", "old", None), ("GONE", "x", None), ("B", "t", "s")}
    updated = conform.sync_vocabulary(held, current, "name", update_attributes=True)
    assert {r["name"]: r["tier"] for r in updated.collect()} == {
        "A": "new", "GONE": "x", "B": "t"}
