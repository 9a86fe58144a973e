from __future__ import annotations

from datetime import date

import pytest
from pyspark.sql import functions as F

from shelfmark.operators import (
    dedupe, guards, keys, merge, profile, ranking, reconcile, running, trace,
)


def plan(frame):
    return frame._jdf.queryExecution().toString()


def rows(frame):
    return sorted(tuple(r) for r in frame.collect())


def test_first_per_key_is_total_and_cuts_before_the_shuffle(spark):
    data = [("a", 1, "x"), ("a", 1, "b"), ("a", 0, "z"), ("b", None, "q")]
    kept = None
    for parts in (1, 3):
        frame = spark.createDataFrame(data, "k string, n int, t string").repartition(parts)
        kept = dedupe.first_per_key(frame, ["k"], [F.desc("n")])
        assert rows(kept) == [("a", 1, "b"), ("b", None, "q")]
    assert plan(kept).count("WindowGroupLimit") >= 2  # once per task, once per key


def test_top_per_key(spark):
    frame = spark.range(10).select((F.col("id") % 2).alias("k"), "id")
    top = dedupe.top_per_key(frame, ["k"], [F.desc("id")], 2, "r")
    assert rows(top) == [(0, 6, 2), (0, 8, 1), (1, 7, 2), (1, 9, 1)]


def test_insert_only_merge(spark):
    target = spark.createDataFrame([(1, "old")], "k int, v string")
    source = spark.createDataFrame([(1, "new"), (2, "new")], "k int, v string")
    once = merge.merge_insert_only(target, source, ["k"])
    assert rows(once) == [(1, "old"), (2, "new")]
    assert rows(merge.merge_insert_only(once, source, ["k"])) == rows(once)


def test_rows_of_a_scope_that_is_not_held_are_not_joined(spark):
    target = spark.createDataFrame([(1, 1, "x"), (2, 1, "x")], "k int, d int, v string")
    source = spark.createDataFrame([(1, 1, "y"), (3, 1, "y"), (1, 2, "y"), (1, 2, "y"), (1, None, "y"),
                                    (None, 1, "y")], "k int, d int, v string")
    got = merge.new_rows(target, source, ["k", "d"], held_within=("d", [1, None]))
    told = lambda frame: sorted(map(str, frame.collect()))
    assert told(got) == told(merge.new_rows(target, source, ["k", "d"]))
    assert got.columns == source.columns and got.count() == 5


def test_insert_only_merge_within_a_scope(spark):
    target = spark.createDataFrame([(1, date(2026, 1, 1)), (1, date(2026, 1, 2))], "k int, date date")
    source = spark.createDataFrame([(1, date(2026, 1, 2)), (2, date(2026, 1, 2))], "k int, date date")
    assert rows(merge.new_rows(
        target, source, ["k", "date"], ("date", merge.values_of(source, "date")))) == [(2, date(2026, 1, 2))]


def test_upsert(spark):
    target = spark.createDataFrame([(10, "a", 1), (11, "b", 2)], "key int, name string, v int")
    source = spark.createDataFrame([("b", None), ("c", 3)], "name string, v int")
    merged = merge.merge_upsert(target, source, ["name"])
    assert sorted(map(str, rows(merged.select("name", "key", "v").na.fill(-1)))) == [
        "('a', 10, 1)", "('b', 11, -1)", "('c', -1, 3)"]
    kept = merge.merge_upsert(target, source, ["name"], updated=[])
    assert rows(kept.where("name = 'b'")) == [(11, "b", 2)]
    assert rows(kept.where("name = 'c'").select("name", "v")) == [("c", 3)]


def test_upsert_refuses_a_repeated_key(spark):
    target = spark.createDataFrame([("a", 1)], "name string, v int")
    source = spark.createDataFrame([("b", 1), ("b", 2)], "name string, v int")
    with pytest.raises(Exception, match="repeats a key"):
        merge.merge_upsert(target, source, ["name"]).collect()


@pytest.mark.parametrize("assign,dense", [(keys.dense_keys, True), (keys.interleaved_keys, False)])
def test_keys(spark, assign, dense):
    frame = spark.range(5000).select(F.col("id").cast("string").alias("n"), F.lit("x").alias("v"))
    first = {r["n"]: r["key"] for r in assign(frame.repartition(3), "key", ["n"], 100).collect()}
    again = {r["n"]: r["key"] for r in assign(frame.repartition(7), "key", ["n"], 100).collect()}
    assert first == again and len(set(first.values())) == 5000 and min(first.values()) > 100
    if dense:
        assert sorted(first.values()) == list(range(101, 5101))


def test_highest_key(spark):
    held = spark.createDataFrame([(7,), (3,)], "key long")
    fresh = spark.createDataFrame([("n",)], "n string")
    assert keys.dense_keys(fresh, "key", ["n"], keys.highest_key(held, "key")).first()["key"] == 8
    none = keys.highest_key(held.limit(0), "key")
    assert keys.dense_keys(fresh, "key", ["n"], none).first()["key"] == 1


def test_sum_before(spark):
    frame = spark.range(100).select((F.col("id") % 3).alias("g"), F.col("id").alias("p"))
    summed = running.sum_before(frame, ["g"], "p", F.col("p"), "s", block=7)
    for g, p, s in rows(summed):
        assert s == sum(q for q in range(p) if q % 3 == g)
    dense = running.dense_position(frame, ["g"], "p", "i")
    assert all(i == p // 3 for _, p, i in rows(dense))


def listing_frame(spark, yields, pages=1):
    return spark.createDataFrame(
        [("s", "t", i, n, pages) for i, n in enumerate(yields)],
        "site string, scraped_at string, ix int, new_products int, pages_fetched int")


def walked(frame, **options):
    marked = trace.tail_cutoff(frame, **options)
    return [r["walked"] for r in marked.orderBy("ix").collect()]


def test_barren_tail(spark):
    frame = listing_frame(spark, [30, 0, 3, 40, 0, 1, 2, 3, 4, 50])
    assert walked(frame) == [True] * 9 + [False]
    assert walked(frame, guaranteed=5) == [True] * 10
    assert walked(listing_frame(spark, [0] * 12), guaranteed=4) == [True] * 9 + [False] * 3


def sequential_walk(yields, pages, guaranteed, patience, min_new, budget):
    kept, barren, spent = [], 0, 0
    for i, n in enumerate(yields):
        if i >= guaranteed and (barren >= patience or spent >= budget):
            break
        kept.append(i)
        spent += pages[i]
        if i >= guaranteed:
            barren = barren + 1 if n < min_new else 0
    return kept


def test_tail_cutoff_against_a_sequential_walk(spark):
    import random

    random.seed(3)
    cases, data = {}, []
    for s in range(60):
        yields = [random.choice([0, 5, 30]) for _ in range(random.randint(1, 40))]
        pages = [random.randint(0, 9) for _ in yields]
        cases[f"s{s}"] = sequential_walk(yields, pages, 3, 3, 25, 60)
        data += [(f"s{s}", "t", i, n, p) for i, (n, p) in enumerate(zip(yields, pages))]
    frame = spark.createDataFrame(
        data, "site string, scraped_at string, ix int, new_products int, pages_fetched int")
    got = {s: [] for s in cases}
    marked = trace.tail_cutoff(frame, guaranteed=3, patience=3, page_budget=60)
    for r in marked.where("walked").orderBy("ix").collect():
        got[r["site"]].append(r["ix"])
    assert got == cases


def test_first_delivery_and_yield(spark):
    pages = spark.createDataFrame(
        [("s", "t", 0, "u", ["1", "2", "2"]), ("s", "t", 1, "a", ["2", "3"]), ("s", "t", 2, "b", ["3"])],
        "site string, scraped_at string, seq int, listing string, product_ids array<string>")
    delivered = trace.deliveries(pages)
    first = trace.first_deliveries(delivered)
    assert rows(first.select("product_id", "listing")) == [("1", "u"), ("2", "u"), ("3", "a")]
    assert rows(trace.listing_yield(delivered).drop("site", "scraped_at")) == [
        ("a", 2, 1), ("b", 1, 0), ("u", 3, 2)]


def test_vendors(spark):
    bodies = spark.createDataFrame(
        [("s", "t", str(i), v) for i, v in enumerate(["a", "a", "A", None, "", "b", "c"])]
        + [("m", "t", "1", "only")],
        "site string, scraped_at string, product_id string, vendor string")
    assert rows(trace.vendor_tally(bodies).where("site = 's'").select("vendor", "products")) == [
        ("A", 1), ("a", 2), ("b", 1), ("c", 1)]
    assert rows(trace.brand_shape(bodies).select("site", "vendors", "shape")) == [
        ("m", 1, "single-brand"), ("s", 4, "multi-brand")]


def test_collections(spark):
    frame = spark.createDataFrame([("a", 3), ("", 9), (None, 9), ("b", 0), ("c", 5)],
                                  "handle string, products_count int")
    kept = trace.collections_worth_walking(frame)
    assert rows(kept) == [("a", 3), ("c", 5)]
    assert [r["handle"] for r in ranking.largest(kept, "products_count", "handle", 1).collect()] == ["c"]


def test_beyond_largest(spark):
    frame = spark.createDataFrame([("g", c, n) for c, n in zip("abcd", (5, 9, 5, 1))]
                                  + [("h", "a", 2)], "g string, c string, n int")
    assert rows(ranking.beyond_largest(frame, ["g"], "n", "c", 2)) == [("g", 2, 6), ("h", 0, 0)]


def test_set_difference(spark):
    left = spark.createDataFrame([("a",), ("b",), ("b",), (None,)], "k string")
    right = spark.createDataFrame([("b",), ("c",), (None,)], "k string")
    assert rows(reconcile.set_difference(left, right, ["k"])) == [
        ("a", "left_only"), ("c", "right_only")]


def test_reconcile_datasets(spark):
    kind = "dataset string, file string, size long"
    local = spark.createDataFrame(
        [("a", "1", 5), ("a", "2", 5), ("a", "3", 5), ("b", "1", 1)], kind)
    held = spark.createDataFrame(
        [("a", "1", 5), ("a", "2", 6), ("a", "9", 5), ("z", "1", 1)], kind)
    got = reconcile.reconcile_datasets(local, held).select("dataset", "file", "outcome")
    assert rows(got) == [("a", "2", "size_differs"), ("a", "3", "missing"), ("a", "9", "stale"),
                         ("b", "1", "nothing_held"), ("z", "1", "orphan_dataset")]


def test_reconcile_crawl_files(spark):
    local = spark.createDataFrame(
        [("k", "k-1.json", 5), ("m", "m-1.json", 5), ("n", "n-1.json", 5), ("o", "o-1.json", 5)],
        "retailer string, file string, size long")
    held = spark.createDataFrame(
        [("k-1.json", "s/k/k-1.json", 5), ("m-1.json", "s/x/m-1.json", 5),
         ("n-1.json", "s/n/n-1.json", 4), ("k-0.json", "s/k/k-0.json", 4)],
        "file string, path string, size long")
    got = reconcile.reconcile_crawl_files(local, held).select("file", "outcome")
    assert rows(got) == [("k-0.json", "earlier_crawl"), ("m-1.json", "wrong_prefix"),
                         ("n-1.json", "size_differs"), ("o-1.json", "missing")]


def test_profile(spark):
    frame = spark.createDataFrame([(1, "a"), (2, None), (2, "a"), (3, "b")], "n int, t string")
    expected = [("n", 4, 4, "1.0000", 3), ("t", 4, 3, "0.7500", 2)]
    for approximate in (False, True):
        got = profile.profile(frame, approximate=approximate)
        assert [(c, n, f, str(r), d) for c, n, f, r, d in rows(got)] == expected
    assert [(c, f) for c, _, f, _ in rows(profile.fill_rates(frame))] == [("n", 4), ("t", 3)]


def test_guards(spark):
    stamps = spark.createDataFrame([("a",), ("a",)], "scraped_at string")
    assert guards.require_single_crawl(stamps) == "a"
    for bad in (stamps.limit(0), stamps.union(spark.createDataFrame([("b",)], "s string"))):
        with pytest.raises(guards.InputError):
            guards.require_single_crawl(bad)
    with pytest.raises(guards.InputError, match="empty"):
        guards.require_rows(full=stamps, empty=stamps.limit(0))
    sites = spark.createDataFrame([("a", True), ("b", False)], "name string, enabled boolean")
    assert rows(guards.select_sites(sites)) == [("a", True)]
    assert guards.select_sites(sites, include_disabled=True).count() == 2
    assert rows(guards.select_sites(sites, ["b"])) == [("b", False)]
    with pytest.raises(guards.InputError, match="zz"):
        guards.select_sites(sites, ["a", "zz"])
    listing = spark.createDataFrame([("brands", 1), ("tiers", 0)], "dataset string, files long")
    guards.require_datasets(listing, ["brands"])
    with pytest.raises(guards.InputError, match="tiers"):
        guards.require_datasets(listing, ["brands", "tiers"])


def test_rows_without_a_key_go_before_the_shuffle(spark):
    from shelfmark.operators.prefilter import key_bits, perhaps_among
    rows = spark.range(20_000).select(F.col("id").cast("string").alias("a"),
                                      F.when(F.col("id") % 9 > 0, F.col("id") % 5).alias("b"))
    keyed = rows.where("a < 5000 AND b IS NOT NULL")
    left = perhaps_among(rows, keyed, ["a", "b"])
    assert left.columns == ["a", "b"] and left.where("a < 5000 AND b IS NOT NULL").count() \
        == keyed.count() <= left.count() < keyed.count() + 20
    assert perhaps_among(rows, keyed.limit(0), ["a", "b"]).count() == 0
    assert key_bits(rows, ["a"]).agg(F.max(F.octet_length("bits"))).first()[0] == 4096
