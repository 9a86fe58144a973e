"""Hot keys, and plans that have to hold at scale."""

from __future__ import annotations

from decimal import Decimal
from pathlib import Path

from pyspark.sql import functions as F

from shelfmark.operators import dedupe, keys, lookup, merge, reconcile, trace
from shelfmark.plans import conform
from shelfmark.quality import processed
from shelfmark.session import cut_lineage
from shelfmark.sources.tables import APPEND, TableStore

from .conftest import document, write_document
from shelfmark.sources import raw

ROWS = 30_000


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def hot(spark, rows=ROWS):
    """A third of all rows under one key."""
    return spark.range(rows).select(
        "id", F.when(F.col("id") % 3 == 0, "hot").otherwise(
            F.concat(F.lit("k"), (F.col("id") % 997).cast("string"))).alias("k"))


def test_dedupe_sends_one_row_per_task_and_key(spark):
    kept = dedupe.first_per_key(hot(spark), ["k"], [F.desc("id")])
    assert kept.count() == 998
    assert kept.where("k = 'hot'").first()["id"] == ROWS - 3
    text = plan(kept)
    assert text.index("Final") < text.index("Exchange hashpartitioning") < text.index("Partial")


def test_a_hot_product_keeps_all_its_variants(spark, vocabularies):
    ids = hot(spark)
    described = ids.select(F.col("k").alias("product")).distinct().select(
        "product", F.lit("R").alias("retailer"), F.lit("2026-08-30").cast("date").alias("date"),
        F.lit(1).alias("size_slot"), F.lit(None).cast("int").alias("color_slot"))
    sold = ids.select(
        F.col("id").cast("string").alias("id"), F.col("k").alias("product_id"),
        F.lit("r").alias("site"), F.lit("2026-08-30T09:14:02Z").alias("scraped_at"),
        F.lit(None).cast("string").alias("sku"), F.lit(" m ").alias("option1"),
        *(F.lit(None).cast("string").alias(c) for c in ("option2", "option3")),
        F.lit("8.00").alias("price"), F.lit("10").alias("compare_at_price"),
        F.lit(True).alias("available"))
    currencies = spark.createDataFrame([("R", "EUR")], "retailer string, currency string").select(
        "retailer", F.lit("2026-08-30").cast("date").alias("date"), "currency")
    made = conform.variants(sold, described, currencies)
    row = made.agg(F.count(F.lit(1)), F.countDistinct("variant"), F.sum("discount"),
                   F.min("size"), F.min("currency")).first()
    assert tuple(row) == (ROWS, ROWS, Decimal(20 * ROWS), "M", "EUR")


def test_a_hot_product_in_one_listing(spark):
    ids = hot(spark, 9000)
    delivered = ids.select(
        F.lit("s").alias("site"), F.lit("t").alias("scraped_at"), F.col("id").alias("seq"),
        F.lit(0).alias("pos"), (F.col("id") % 7).cast("string").alias("listing"),
        F.col("k").alias("product_id"))
    yields = trace.listing_yield(delivered).collect()
    assert sum(r["delivered"] for r in yields) == 9000
    assert sum(r["new_products"] for r in yields) == ids.select("k").distinct().count()


def test_keys_do_not_go_through_one_task(spark):
    rows = spark.range(1000).select(F.col("id").cast("string").alias("n"))
    assert "SinglePartition" not in plan(keys.interleaved_keys(rows, "key", ["n"]))
    # Only the bucket counts meet in one task.
    text = plan(keys.dense_keys(rows, "key", ["n"]))
    assert text.count("SinglePartition") <= 1


def test_repeats_are_folded_before_the_shuffle(spark):
    frame = hot(spark)
    for made in (processed.grain_check(frame, "t", ["k"]),
                 processed.orphan_check(frame, "t", frame.limit(0), "p", ["k"]),
                 reconcile.set_difference(frame.select("k"), frame.select("k"), ["k"])):
        text = plan(made)
        assert text.index("HashAggregate(keys=[k", text.index("Exchange hashpartitioning(k")) > 0


def test_vocabulary_is_broadcast_only_when_small(spark, vocabularies, monkeypatch):
    frame = spark.range(10).select(F.col("id").cast("string").alias("v"))
    brands = vocabularies["brands"]
    resolved = lookup.resolve(frame, b=("v", brands))
    assert "ResolvedHint (strategy=broadcast)" in resolved._jdf.queryExecution().analyzed().toString()
    monkeypatch.setattr(lookup, "BROADCAST_SPELLINGS", 1)
    large = lookup.resolve(frame, b=("v", brands))
    assert "ResolvedHint" not in large._jdf.queryExecution().analyzed().toString()
    assert large.collect() == resolved.collect()


def test_a_merge_reads_only_the_partitions_it_touches(spark, tmp_path):
    store = TableStore(spark, str(tmp_path / "held"))
    load = store.begin()
    load.write("t", spark.range(100).repartition(1).select("id", (F.col("id") % 50).alias("d")),
               APPEND, partition_by="d")
    load.commit()
    spark.range(150).select("id", F.lit(7).cast("long").alias("d")).write.parquet(
        str(tmp_path / "run"))
    run = spark.read.parquet(str(tmp_path / "run"))
    names = spark.createDataFrame([(i,) for i in range(60)], "id bigint")
    for source, fresh in ((run, 148), (run.join(names, "id"), 58)):
        found = merge.new_rows(store.read("t"), source, ["id", "d"],
                               ("d", merge.values_of(source, "d")))
        assert found.count() == fresh
        held = store.read("t").where(F.col("d").isin(merge.values_of(source, "d")))
        files = held.select(F.input_file_name()).distinct().count()
        assert files == 1 and "PartitionFilters: [isnotnull(d" in plan(found)
        assert "(d#" in plan(found) and " = 7)" in plan(found)


def test_documents_are_read_for_the_fields_in_use_only(spark, tmp_path):
    write_document(tmp_path, document())
    documents = raw.read_documents(spark, str(tmp_path))
    text = plan(documents.select("site", "currency"))
    assert "products" not in text and "responses" not in text


def test_tails_of_long_crawls(spark):
    # One store with far more listings than a block of the running sum holds.
    frame = spark.range(5000).select(
        F.lit("s").alias("site"), F.lit("t").alias("scraped_at"), F.col("id").cast("int").alias("ix"),
        F.when(F.col("id").between(3000, 3004), 1).otherwise(30).alias("new_products"),
        F.lit(1).cast("long").alias("pages_fetched"))
    walked = trace.tail_cutoff(frame, page_budget=None).where("walked").agg(F.max("ix")).first()[0]
    assert walked == 3004
    budget = trace.tail_cutoff(frame, patience=None, page_budget=2500)
    assert budget.where("walked").count() == 2500


def test_what_is_cut_is_a_compressed_table(spark, tmp_path):
    frame = spark.range(200_000).select(
        F.lit("the same text in every row").alias("a b"), F.array(F.lit(None).cast("int")).alias("x"),
        F.create_map(F.lit("k"), F.col("id")).alias("m"))
    kept = cut_lineage(frame)
    assert kept.dtypes == frame.dtypes and kept.count() == 200_000
    assert kept.where("x[0] IS NULL AND m['k'] >= 0").count() == 200_000
    files = [Path(f.removeprefix("file://")) for f in kept.inputFiles()]
    assert files and sum(f.stat().st_size for f in files) < 4_000_000
    assert cut_lineage(frame.limit(0)).collect() == []
