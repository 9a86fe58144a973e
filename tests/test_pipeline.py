from __future__ import annotations

from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from shelfmark.operators.guards import InputError
from shelfmark.plans import conform, load, run, star, statistics
from shelfmark.quality import findings, loaded, processed
from shelfmark.schemas import ANALYTICAL, PROCESSED
from shelfmark.sources import raw
from shelfmark.sources.tables import (APPEND, REPLACE, TableMissing, TableStore, dataset_files,
                                      footer_max)

from .conftest import document, product, write_document

DAY_1, DAY_2 = "2026-08-30T09:14:02Z", "2026-08-31T09:00:00Z"


@pytest.fixture(scope="module")
def processed_run(spark, vocabularies, tmp_path_factory):
    """Two crawls on two dates, each conformed into a store of its own."""
    root = tmp_path_factory.mktemp("runs")
    stores = {}
    for day, stamp in enumerate((DAY_1, DAY_2), 1):
        source = root / f"raw{day}"
        source.mkdir()
        write_document(source, document(stamp=stamp))
        write_document(source, document("nordic", stamp, currency="SEK", country="Sverige",
                                        brand_override="Alaïa"))
        shredded = run.shred_run(spark, str(source), str(root / f"flat{day}"))
        stores[day] = TableStore(spark, str(root / f"run{day}"))
        stores[f"report{day}"] = run.conform_run(shredded, vocabularies, stores[day])
        stores[f"shredded{day}"] = shredded
    return stores


def tables(store):
    return {t: store.read(t) for t in store.tables()}


def test_processed_tables(spark, processed_run):
    store = processed_run[1]
    assert store.tables() == set(PROCESSED)
    products = {(r["retailer"], r["product"]): r for r in store.read("products").collect()}
    assert set(products) == {(s, p) for s in ("KIOSK", "NORDIC") for p in ("1", "2", "4")}
    one = products["KIOSK", "1"]
    assert (one["name"], one["brand"], one["category"], one["gender"], one["color"],
            one["material"], one["date"]) == (
        "Product 1", "SAINT LAURENT", "SHOES", "MEN", "RED / BLUE", None, date(2026, 8, 30))
    assert products["KIOSK", "2"]["gender"] == "UNISEX"
    variants = {(r["retailer"], r["variant"]): r for r in store.read("variants").collect()}
    assert len(variants) == 8
    sold = variants["NORDIC", "1-1"]
    assert (sold["size"], sold["color"], sold["price"], sold["currency"], sold["original_price"],
            sold["discount"], sold["available"], sold["sku"]) == (
        "38", "RED", Decimal("80.00"), "SEK", Decimal("100.00"), Decimal("20.00"), True, "A 1")
    free = variants["KIOSK", "1-2"]
    assert (free["price"], free["original_price"], free["discount"], free["sku"]) == (None,) * 4
    retailers = {r["name"]: r["country"] for r in store.read("retailers").collect()}
    assert retailers == {"KIOSK": "IT", "NORDIC": "SE"}
    crawls = {r["site"]: r["name"] for r in store.read("crawls").collect()}
    assert crawls == {"KIOSK": None, "NORDIC": "ALAÏA"}
    for name, spec in PROCESSED.items():
        types = {f.name: f.dataType.simpleString() for f in store.read(name).schema}
        assert types == spec.types, name


def test_run_report(spark, processed_run, vocabularies):
    report = processed_run["report1"]
    assert report.rows["variants"] == 8 and report.rows["products"] == 6
    assert report.vocabularies["brands"] == (4, 4)
    assert report.unmatched["vendor"] == ([("Unknown Maker", 2)], False)
    store = processed_run[1]
    dry = run.conform_run(processed_run["shredded1"], vocabularies, store, dry_run=True)
    assert dry.rows == report.rows and dry.vocabularies["brands"] == (0, 4)
    assert store.counts().select("load").distinct().count() == 1


def test_processed_checks(spark, processed_run):
    store = processed_run[1]
    staged = spark.createDataFrame([("kiosk",), ("nordic",)], "site string")
    got = processed.processed_checks(tables(store), staged)
    assert {(r["level"], r["where"], r["check"]) for r in got.collect()} == {
        ("WARN", "products", "material is null in every row")}
    # The same of the columns from the pass that wrote the tables.
    assert {tuple(r) for r in processed_run["report1"].findings.collect()} == {
        tuple(r) for r in got.collect() if "null in every row" in r["check"]}
    assert store.check_present(PROCESSED) == []
    assert store.check_present([*PROCESSED, "more"])[0][:2] == ("ERROR", "more")
    assert store.check_present([])[0][0] == "WARN"


def test_broken_tables_are_found(spark, processed_run):
    broken = tables(processed_run[1])
    variants = broken["variants"]
    broken["variants"] = variants.unionByName(variants.limit(1)).withColumn(
        "product", F.when(F.col("variant") == "2-1", "99").otherwise(F.col("product"))).withColumn(
        "price", F.when(F.col("variant") == "2-2", F.lit(-1)).otherwise(F.col("price")).cast("decimal(12,2)")).withColumn(
        "currency", F.when(F.col("variant") == "2-2", "usd").otherwise(F.col("currency"))).withColumn(
        "available", F.lit(None).cast("boolean"))
    broken["brands"] = broken["brands"].drop("tier")
    broken["retailers"] = broken["retailers"].limit(0)
    staged = spark.createDataFrame([("kiosk",), ("lost",)], "site string")
    got = {(r["where"], r["check"]): r["n"] for r in
           processed.processed_checks(broken, staged).collect()}
    assert got["variants", "duplicate on (variant, product, retailer, date)"] == 1
    assert got["variants", "not in products"] == 2
    assert got["variants", "price at or below zero"] == 2
    assert got["variants", "currency is not upper case"] == 2
    assert got["variants", "currency not in currencies"] == 1
    assert got["variants", "available is null"] == 9
    assert got["brands", "tier is missing"] == 1
    assert got["retailers", "no rows"] == 1
    assert got["coverage", "staged site missing from crawls"] == 1
    assert got["coverage", "site in crawls, nothing staged"] == 1


def test_money_checks(spark):
    rows = [("1", None, None), ("0", None, None), ("5", "5", "0"), (None, "5", "10"),
            ("5", "9", None), ("1", "100", "99")]
    frame = spark.createDataFrame(rows, "p string, o string, d string").select(
        *(F.col(a).cast(f"decimal({n},2)").alias(b) for a, b, n in (
            ("p", "price", 12), ("o", "original_price", 12), ("d", "discount", 20))))
    assert {r["check"]: r["n"] for r in processed.money_checks(frame).collect()} == {
        "price at or below zero": 1, "original_price not above price": 1,
        "original_price without price": 1, "discount and original_price disagree": 1,
        "discount outside 0-95": 1}


def test_best_crawl_of_a_day(spark, vocabularies):
    staged = spark.createDataFrame(
        [("k", "u", None, "usd", None, DAY_1, 0, n, 1, 0, 0) for n in (0, 44958)],
        "site string, base_url string, country string, currency string, brand_override string, "
        "scraped_at string, products_received long, products_stored long, pages long, "
        "short_pages long, collections_crawled long")
    rows = conform.crawls(staged, vocabularies["currencies"]).collect()
    assert [(r["products_stored"], r["currency"]) for r in rows] == [(44958, "USD")]


def staged_rows(spark, products, site="kiosk"):
    frame = spark.createDataFrame([(site, DAY_1, p) for p in products.items()],
                                  "site string, scraped_at string, "
                                  "p struct<k string, b struct<id string, title string, vendor string, "
                                  "product_type string, tags array<string>, options array<struct<name string, "
                                  "position int, values array<string>>>>>")
    return frame.select("p.b.*", "site", "scraped_at")


def body(pid, vendor="YSL", tags=(), options=()):
    return (pid, "t", vendor, "Boots", list(tags), list(options))


def test_described_products(spark, vocabularies):
    products = {"a": body("1", tags=["Gender: Women"]), "b": body("2", "nobody"),
                "c": body("3", options=[("Gender", 1, ["Men"]), ("Taille", 3, ["S"])], tags=["girls"])}
    staged = staged_rows(spark, products)
    args = vocabularies["brands"], vocabularies["categories"], vocabularies["genders"]
    plain = {r["product"]: r for r in conform.described_products(staged, *args).collect()}
    assert set(plain) == {"1", "3"}
    assert plain["1"]["gender"] is None and plain["3"]["gender"] == "UNISEX"
    assert (plain["3"]["size_slot"], plain["3"]["color_slot"]) == (3, None)
    stripped = conform.described_products(staged, *args, strip_tag_prefix=True)
    assert stripped.where("product = '1'").first()["gender"] == "WOMEN"
    override = spark.createDataFrame([("kiosk", "Acne"), ("kiosk", None)], "site string, brand_override string")
    named = conform.described_products(staged, *args, apply_override=override)
    assert {r["brand"] for r in named.collect()} == {"ACNE STUDIOS"} and named.count() == 3


def test_variant_ids_are_unique_within_a_product_only(spark, vocabularies):
    staged = staged_rows(spark, {"a": body("1"), "b": body("2")})
    described = conform.described_products(
        staged, vocabularies["brands"], vocabularies["categories"], vocabularies["genders"])
    rows = [("9", p, "kiosk", DAY_1, None, "x", None, None, price, None, True)
            for p, price in (("1", "5"), ("2", "bad"), ("1", "5"), ("7", "1"))]
    sold = spark.createDataFrame(
        rows, "id string, product_id string, site string, scraped_at string, sku string, option1 string, "
        "option2 string, option3 string, price string, compare_at_price string, available boolean")
    currencies = spark.createDataFrame([], "retailer string, date date, currency string")
    got = conform.variants(sold, described, currencies).collect()
    assert sorted((r["product"], r["price"]) for r in got) == [("1", Decimal("5.00")), ("2", None)]
    assert [r["currency"] for r in got] == [None, None]


# ── loads ────────────────────────────────────────────────────────────────────

@pytest.fixture(scope="module")
def loaded_model(spark, processed_run, tmp_path_factory):
    root = tmp_path_factory.mktemp("warehouse")
    history, model = TableStore(spark, f"{root}/history"), TableStore(spark, f"{root}/model")
    first = load.load_processed(processed_run[1], history)
    one = load.load_analytical(history, model)
    keys = {r["name"]: r["brand_key"] for r in model.read("dim_brand").collect()}
    return {"history": history, "model": model, "first": first, "one": one, "keys": keys}


def test_first_load(spark, processed_run, loaded_model):
    model, history = loaded_model["model"], loaded_model["history"]
    assert loaded_model["first"]["variants"] == 8
    added = loaded_model["one"].added
    assert added["fact_product_observation"] == 8 and added["dim_product"] == 6
    assert loaded_model["one"].unresolved == 0
    assert model.tables() == set(ANALYTICAL)
    for name, ddl in ANALYTICAL.items():
        declared = dict(part.split() for part in ddl.split(", "))
        assert {f.name: f.dataType.simpleString() for f in model.read(name).schema} == declared
    assert sorted(loaded_model["keys"].values()) == [1, 2, 3, 4]


def test_second_load(spark, processed_run, loaded_model):
    model, history = loaded_model["model"], loaded_model["history"]
    again = load.load_processed(processed_run[1], history)
    assert [again[t] for t in ("crawls", "dates", "products", "variants")] == [0, 0, 0, 0]
    assert set(load.load_analytical(history, model).added.values()) == {0}

    second = load.load_processed(processed_run[2], history)
    assert (second["variants"], second["dates"], second["crawls"]) == (8, 1, 2)
    more = load.load_analytical(history, model, date="2026-08-31").added
    assert (more["fact_product_observation"], more["dim_product"], more["dim_date"],
            more["dim_brand"]) == (8, 6, 1, 0)
    facts = model.read("fact_product_observation")
    assert facts.count() == 16 and facts.select("product_key").distinct().count() == 8
    assert model.read("dim_product").select("product_key").distinct().count() == 12
    assert {r["name"]: r["brand_key"] for r in model.read("dim_brand").collect()} == loaded_model["keys"]

    day = "2026-08-31"
    run_tables, held = tables(processed_run[2]), tables(history)
    clean = loaded.processed_load_checks(run_tables, held, day)
    assert clean.count() == 0 and loaded.processed_load_checks(run_tables, held).count() == 0
    first_run = loaded.processed_load_checks(tables(processed_run[1]), held, DAY_1[:10])
    assert first_run.count() == 0
    dims = tables(model)
    assert loaded.analytical_load_checks(held, dims).count() == 0
    assert loaded.latest_date(held["products"]).first()["date"] == date(2026, 8, 31)
    coverage = {r["column"]: str(r["coverage"]) for r in
                loaded.fact_coverage(dims["fact_product_observation"]).collect()}
    assert coverage == {"brand_key": "1.0000", "category_key": "1.0000", "currency_key": "1.0000"}

    held["variants"] = held["variants"].where("variant not in ('1-1', '1-2')")
    dims["dim_tier"] = dims["dim_tier"].limit(0)
    dims["fact_product_observation"] = dims["fact_product_observation"].withColumn(
        "brand_key", F.lit(None).cast("bigint")).withColumn(
        "date_key", F.when(F.col("variant_id") != "2-2", F.col("date_key")))
    got = {(r["where"], r["check"]): r["n"] for r in
           loaded.analytical_load_checks(held, dims, day).collect()}
    assert got["dim_tier", "name has no row in the dimension"] == 2
    # Of the crawl's eight rows the history lost four, the fact the date of two.
    assert got["fact_product_observation 2026-08-31", "rows differ from the processed rows"] == 2
    assert got["fact_product_observation", "date_key is null"] == 4
    assert got["fact_product_observation", "brand_key is null in every row"] == 16
    off = loaded.processed_load_checks(run_tables, held, day).collect()
    assert [(r["where"], r["n"], r["sample"]) for r in off] == [("variants", 4, "4 of 8")]


def held_dimensions(spark, **rows):
    return {name: spark.createDataFrame(rows.get(name, []), ANALYTICAL[name])
            for name in star.DIMENSIONS}


def test_type_1_dimensions(spark):
    held = held_dimensions(
        spark, dim_brand=[(1, "A", 1, 1), (2, "GONE", 1, 1)], dim_segment=[(1, "S"), (2, "T")],
        dim_tier=[(1, "L")], dim_retailer=[(5, "K", "old", 1)], dim_country=[(1, "IT", "ITALY")])
    brands = spark.createDataFrame([("A", "T", "NONE"), ("B", "S", "L"), (None, "S", "L")],
                                   "name string, segment string, tier string")
    retailers = spark.createDataFrame([("K", "new", "IT"), ("N", "u", None), ("N", "u", None)],
                                      "name string, url string, country string")
    got = star.dimensions(held, {"brands": brands, "retailers": retailers})
    assert {tuple(r) for r in got["dim_brand"].collect()} == {
        (1, "A", 2, None), (2, "GONE", 1, 1), (3, "B", 1, 1)}
    assert {tuple(r) for r in got["dim_retailer"].collect()} == {
        (5, "K", "new", 1), (6, "N", "u", None)}
    assert got["dim_segment"].count() == 2
    twice = retailers.unionByName(retailers.withColumn("url", F.lit("other")))
    with pytest.raises(Exception, match="repeats a key: dim_retailer"):
        star.dimensions(held, {"retailers": twice})["dim_retailer"].collect()


def test_first_attributes_stay_and_numbers_go_on(spark):
    held = held_dimensions(spark, dim_country=[(1, "IT", "ITALY")], dim_tier=[(7, "L")])
    countries = spark.createDataFrame([("IT", "ITALIA"), ("SE", "SWEDEN"), (None, "X")],
                                      "code string, name string")
    names = spark.createDataFrame([("M",), ("L",), ("N",), ("M",)], "name string")
    got = star.dimensions(held, {"countries": countries, "tiers": names, "segments": names})
    assert sorted(tuple(r) for r in got["dim_country"].collect()) == [
        (1, "IT", "ITALY"), (2, "SE", "SWEDEN")]
    tiers = {r["name"]: r["tier_key"] for r in got["dim_tier"].collect()}
    assert tiers["L"] == 7 and sorted(tiers.values()) == [7, 8, 9]
    assert sorted(r["segment_key"] for r in got["dim_segment"].collect()) == [1, 2, 3]
    again = star.dimensions(got, {"tiers": names, "countries": countries})
    assert {r["name"]: r["tier_key"] for r in again["dim_tier"].collect()} == tiers


def test_unresolved_products_are_reported_not_loaded(spark):
    observed = spark.createDataFrame(
        [("1", "n", 1, 1, None, None, None, None, 1), ("2", "n", 1, None, None, None, None, None, 1)],
        "product_id string, name string, brand_key bigint, retailer_key bigint, category_key bigint, "
        "gender_key bigint, color string, material string, date_key bigint")
    held = spark.createDataFrame([], ANALYTICAL["dim_product"])
    assert star.unresolved_products(observed).count() == 1
    fresh = star.new_products(held, observed)
    assert [r["product_id"] for r in fresh.collect()] == ["1"]
    assert star.new_products(held.unionByName(fresh), observed).count() == 0


def test_nothing_is_derived_from_empty_tables(spark, tmp_path):
    store = TableStore(spark, str(tmp_path / "a"))
    with pytest.raises(InputError):
        load.load_analytical(store, TableStore(spark, str(tmp_path / "b")))
    with pytest.raises(InputError, match="brands"):
        load.load_processed(store, TableStore(spark, str(tmp_path / "c")))


# ── the store ────────────────────────────────────────────────────────────────

def test_store(spark, tmp_path):
    store = TableStore(spark, str(tmp_path))
    with pytest.raises(TableMissing):
        store.read("t")
    first = store.begin()
    assert first.write("t", spark.range(3)) == 3
    assert store.tables() == set()  # not committed, not visible
    first.commit()
    grown = store.begin()
    assert grown.number > first.number
    grown.write("t", store.read("t").where("id > 0"), REPLACE)  # replaced while read
    grown.write("u", spark.range(2).withColumn("d", F.lit("x")), APPEND, partition_by="d")
    grown.commit()
    assert sorted(r["id"] for r in store.read("t").collect()) == [1, 2]
    failed = store.begin()
    failed.write("u", spark.range(9).withColumn("d", F.lit("y")), APPEND, partition_by="d")
    retry = store.begin()
    retry.write("t", spark.range(1), REPLACE)
    retry.commit()
    assert store.read("u").count() == 2 and store.read("t").count() == 1
    last = store.begin()
    assert last.write("u", spark.range(5).withColumn("d", F.lit("z")), APPEND, partition_by="d") == 5
    assert last.pending("u").count() == 7
    last.commit()
    assert store.read("u").count() == 7 and store.read("u", load=last.number).count() == 5
    assert store.counts().where(F.col("load") == last.number).first()["n_rows"] == 5
    pruned = store.read("u").where("d = 'z'")
    assert "PartitionFilters: [isnotnull(d" in pruned._jdf.queryExecution().toString()


def test_loads_at_once_do_not_meet(spark, tmp_path):
    store = TableStore(spark, str(tmp_path))
    one, two = store.begin(), store.begin()
    one.write("t", spark.range(3), APPEND)
    two.write("t", spark.range(3, 8), APPEND)
    two.commit()
    assert store.read("t").count() == 5
    one.commit()
    assert sorted(r["id"] for r in store.read("t").collect()) == list(range(8))


def test_the_highest_key_is_in_the_footers(spark, tmp_path):
    store = TableStore(spark, str(tmp_path))
    assert store.highest("t", "k") == 0
    for low in (0, 50):
        load = store.begin()
        load.write("t", spark.range(low, low + 50).select(
            F.col("id").alias("k"), (F.col("id") % 3).alias("d")), APPEND, partition_by="d")
        load.commit()
    assert store.highest("t", "k") == 99
    loads = [r["load"] for r in store.counts().collect()]
    text = footer_max(spark, str(tmp_path / "t"), loads, "k bigint, d bigint",
                      "k")._jdf.queryExecution().toString()
    assert "PushedAggregation: [MAX(k)]" in text and "max(k)" in text.lower()


def test_dataset_listing(spark, processed_run):
    listed = raw.list_files(spark, processed_run[1].root, "*.parquet")
    names = {r["dataset"]: r["files"] for r in dataset_files(listed).collect()}
    assert names  # every table lies under its load


# ── findings and statistics ──────────────────────────────────────────────────

def test_report(spark):
    warn = findings.stated(spark, [("WARN", "t", "thin", 3, "x")])
    assert findings.report(warn, "run") == ["WARN t: thin (3), e.g. x"]
    both = warn.unionByName(findings.stated(spark, [("ERROR", "t", "broken", 1, None)]))
    with pytest.raises(findings.QualityError, match="1 error"):
        findings.report(both, "run")
    assert {tuple(r) for r in findings.summary(both).collect()} == {("WARN", 1), ("ERROR", 1)}


def test_uploads(spark):
    kind = "dataset string, file string, size long"
    local = spark.createDataFrame([("a", "1", 5), ("a", "2", 5)], kind)
    held = spark.createDataFrame([("a", "1", 5), ("z", "1", 5)], kind)
    assert sorted((r["level"], r["where"], r["check"]) for r in
                  loaded.dataset_upload_checks(local, held).collect()) == [
        ("ERROR", "a", "missing"), ("ERROR", "z", "orphan_dataset")]
    mine = spark.createDataFrame([("k", "k-1.json", 5)], "retailer string, file string, size long")
    there = spark.createDataFrame([("k-0.json", "s/k/k-0.json", 5)], "file string, path string, size long")
    assert sorted((r["level"], r["check"]) for r in
                  loaded.crawl_upload_checks(mine, there).collect()) == [
        ("ERROR", "missing"), ("WARN", "earlier_crawl")]


def test_stock(spark):
    frame = spark.createDataFrame(
        [("1", True), ("1", False), ("2", True), ("3", False), ("3", None)],
        "product string, available boolean").withColumn("retailer", F.lit("r")).withColumn("date", F.lit("d"))
    row = statistics.stock_summary(frame).first()
    assert (row["products"], row["variants"], row["partly_in_stock"], str(row["partly_share"]),
            str(row["variants_per_product"])) == (3, 5, 1, "0.3333", "1.67")
