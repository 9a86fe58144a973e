from __future__ import annotations

from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from shelfmark import functions as fn


def one(spark, column, value, kind="string"):
    frame = spark.createDataFrame([(value,)], f"v {kind}")
    return frame.select(column(F.col("v")).alias("r")).first()["r"]


@pytest.mark.parametrize("text,expected", [
    ("  a  b\t c ", "a b c"), ("", None), ("   ", None), (None, None), ("x", "x")])
def test_clean_text(spark, text, expected):
    assert one(spark, fn.clean_text, text) == expected


@pytest.mark.parametrize("text,expected", [
    ("Alaïa", "alaia"), ("ACNE-STUDIOS", "acnestudios"), ("& Other", "andother"),
    ("Weiß", "weiss"), ("Lařa", "laa"), ("Œuvre Øst", "oeuvreost"), (None, None)])
def test_fold(spark, text, expected):
    assert one(spark, fn.fold, text) == expected


def test_upper_name(spark):
    assert one(spark, fn.upper_name, " rick   owens ") == "RICK OWENS"


@pytest.mark.parametrize("text,expected", [
    ("0.00", None), ("-1", None), ("x", None), ("12.50", Decimal("12.50")), (None, None)])
def test_money(spark, text, expected):
    assert one(spark, fn.money, text) == expected


@pytest.mark.parametrize("price,compare,kept,strict", [
    ("80", "100", "20.00", "20.00"), ("100", "100", None, None), ("120", "100", None, None),
    ("5.01", "100", "94.99", "94.99"), ("5.00", "100", "95.00", None),
    ("4.99", "100", None, None), (None, "100", None, None), ("80", None, None, None)])
def test_discount(spark, price, compare, kept, strict):
    frame = spark.createDataFrame([(price, compare)], "p string, c string").select(
        F.col("p").cast("decimal(12,2)").alias("p"), F.col("c").cast("decimal(12,2)").alias("c"))
    for keep, expected in ((True, kept), (False, strict)):
        original = fn.sale_reference_price(F.col("p"), F.col("c"), keep_boundary=keep)
        row = frame.select(fn.discount_percent(F.col("p"), original).alias("d")).first()
        assert row["d"] == (None if expected is None else Decimal(expected))


OPTIONS = "array<struct<name string, position bigint, values array<string>>>"


def test_options(spark):
    options = [("Color", 1, ["red ", "Blue"]), (" SIZE ", 2, ["38"])]
    frame = spark.createDataFrame([(options, ["a", " xl ", None])],
                                  f"o {OPTIONS}, s array<string>")
    by = fn.options_by_role(F.col("o"))
    row = frame.select(
        by["size"]["position"].alias("p"),
        fn.in_slot(F.col("s"), by["size"]["position"]).alias("size"),
        fn.in_slot(F.col("s"), by["material"]["position"]).alias("m"),
        fn.in_slot(F.col("s"), F.lit(0)).alias("zero"),
        fn.in_slot(F.col("s"), F.lit(9)).alias("beyond"),
        fn.listed(by["color"]["values"]).alias("c"),
        fn.listed(by["material"]["values"]).alias("none"),
        by["color"]["values"].alias("v")).first()
    assert tuple(row) == (2, "XL", None, None, None, "RED / BLUE", None, ["red ", "Blue"])
    twice = spark.createDataFrame([([("Sex", 1, ["a"]), ("gender", 2, ["b"]), (None, 3, ["c"])],),
                                   (None,), ([],)], f"o {OPTIONS}")
    assert [r[0] for r in twice.select(by["gender"]["position"]).collect()] == [1, None, None]


GENDERS = {"mens": "MEN", "men": "MEN", "womens": "WOMEN", "women": "WOMEN", "boys": "KIDS",
           "girls": "KIDS"}


@pytest.mark.parametrize("values,expected,stripped", [
    (["mens"], "MEN", "MEN"), (["mens", "womens"], "UNISEX", "UNISEX"),
    (["Boys", "Girls"], "KIDS", "KIDS"), (["x"], None, None), (None, None, None),
    ([None], None, None), (["Gender: Women"], None, "WOMEN")])
def test_one_of(spark, values, expected, stripped):
    for strip, wanted in ((False, expected), (True, stripped)):
        assert one(spark, lambda c: fn.one_of(c, GENDERS, "UNISEX", strip_prefix=strip),
                   values, "array<string>") == wanted
    assert one(spark, lambda c: fn.one_of(c, {}, "UNISEX"), values, "array<string>") is None


def test_one_of_takes_any_number_of_spellings(spark):
    many = {f"s{i}": f"V{i % 7}" for i in range(5000)}
    for values, expected in ((["S 499"], "V2"), (["s3", "s10"], "V3"), (["s1", "s2"], "SEVERAL"),
                             (["s5000"], None)):
        assert one(spark, lambda c: fn.one_of(c, many, "SEVERAL"), values,
                   "array<string>") == expected


def test_fold_of_every_special_letter(spark):
    text = "Ø Æ œ ß đ Ł & ÁÀÂÄÃÅ ÉÈÊË ÍÌÎÏ ÓÒÔÖÕ ÚÙÛÜ Ý Ñ Ç Š Ž 9-_[]^\\"
    assert one(spark, fn.fold, text, "string") == (
        "oaeoessdlandaaaaaaeeeeiiiiooooouuuuyncsz9")


@pytest.mark.parametrize("day,expected", [
    (date(2026, 12, 31), (31, 53, 12, 4, "WINTER", 2026)),
    (date(2027, 1, 1), (1, 53, 1, 1, "WINTER", 2027)),
    (date(2026, 8, 30), (30, 35, 8, 3, "SUMMER", 2026))])
def test_calendar(spark, day, expected):
    frame = spark.createDataFrame([(day,)], "d date")
    assert tuple(frame.select(*fn.calendar_columns(F.col("d"))).first()) == expected


def test_seasons(spark):
    rows = spark.range(0, 14).select(fn.season_of(F.col("id")).alias("s")).collect()
    assert [r["s"] for r in rows] == [
        None, "WINTER", "WINTER", "SPRING", "SPRING", "SPRING", "SUMMER", "SUMMER", "SUMMER",
        "AUTUMN", "AUTUMN", "AUTUMN", "WINTER", None]


@pytest.mark.parametrize("stamp,valid,day", [
    ("2026-08-30T09:14:02Z", True, date(2026, 8, 30)),
    ("2026-08-30 09:14:02", False, date(2026, 8, 30)),
    ("2026-13-30T09:14:02Z", False, None), ("", False, None), (None, False, None)])
def test_stamps(spark, stamp, valid, day):
    assert one(spark, fn.is_stamp, stamp) is valid
    assert one(spark, fn.crawl_date, stamp) == day


def test_file_names(spark):
    name = "corner-store-20260830T091402Z.json"
    assert one(spark, fn.retailer_of_file, name) == "corner-store"
    assert one(spark, fn.stamp_of_file, name) == "20260830T091402Z"
    assert one(spark, fn.compact_stamp, "2026-08-30T09:14:02Z") == "20260830T091402Z"
    assert one(spark, fn.base_name, "s/brands/part-0.parquet") == "part-0.parquet"
    assert one(spark, fn.dataset_of, "s/brands/part-0.parquet") == "brands"
    assert one(spark, fn.dataset_of, "part-0.parquet") == ""


def test_crawl_dates_are_utc_in_every_session_zone(spark):
    from pyspark.sql import functions as F

    from shelfmark.functions.calendar import crawl_date
    stamps = spark.createDataFrame([("2026-08-30T23:14:02Z",), ("2026-08-30T00:10:00Z",)], "s string")
    held = spark.conf.get("spark.sql.session.timeZone")
    try:
        for zone in ("UTC", "Asia/Tokyo", "America/Los_Angeles"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            dates = stamps.select(crawl_date(F.col("s")).cast("string")).collect()
            assert [d[0] for d in dates] == ["2026-08-30"] * 2
    finally:
        spark.conf.set("spark.sql.session.timeZone", held)


def test_fold_of_plain_texts_is_that_of_others(spark):
    rows = spark.range(0, 128).select(F.concat(
        F.lit("A"), F.expr("char(id)"), F.lit("z& 9")).alias("s"))
    # An accented letter at the end sends a text the other way.
    other = F.concat("s", F.lit("é"))
    odd = rows.where(F.concat(fn.text.fold(F.col("s")), F.lit("e")) != fn.text.fold(other))
    assert odd.count() == 0
    kept = rows.where(F.concat(fn.text.fold(F.col("s"), keep="\x01"), F.lit("e"))
                      != fn.text.fold(other, keep="\x01"))
    assert kept.count() == 0
    raw = spark.sql("SELECT cast(unhex(h) AS string) AS s FROM VALUES ('41C3A9'), ('4180'), "
                    "('41FF42') v(h)")
    assert [r[0] for r in raw.select(fn.text.fold(F.col("s"))).collect()] == ["ae", "a", "ab"]
