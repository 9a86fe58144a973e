"""Seconds per headline query, warm, as one JSON line.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py [query ...]

Every query is run once to warm up and then timed to its last row (a noop sink, so
nothing is brought to the driver).
"""

from __future__ import annotations

import json
import os
import sys
import time

from shelfmark.queries import REGISTERED
from shelfmark.session import build_session

HEADLINES = (
    "clean_text_documents", "fold_names", "resolve_one_of", "option_slots", "discount_rule",
    "calendar", "lookup_category", "unmatched_report", "allowlist_products", "variant_join",
    "discount_by_brand", "best_per_group", "dedupe_grain", "merge_insert_only",
    "merge_upsert", "dim_brand_type1", "fact_observation", "fact_second_load",
    "dim_product_snapshot", "vendor_check", "qc_columns", "qc_grain",
    "qc_money", "qc_orphans", "shred_documents", "trace_check", "first_delivery",
    "listing_yield", "barren_tail", "profile_columns", "manifest_reconcile", "partial_stock",
)


def seconds(run) -> float:
    started = time.perf_counter()
    run().write.format("noop").mode("overwrite").save()
    return round(time.perf_counter() - started, 3)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session("shelfmark-bench", **{
        "spark.master": f"local[{cpus}]", "spark.sql.shuffle.partitions": cpus,
        "spark.driver.memory": "16g", "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    names = sys.argv[1:] or HEADLINES
    timed = {}
    for name in names:
        def run(name=name):
            return REGISTERED[name].run(spark, folder)
        seconds(run)
        timed[name] = seconds(run)
        print(f"{name} {timed[name]}", file=sys.stderr, flush=True)
    spark.stop()
    print(json.dumps({
        "metric": "headline queries, warm", "value": round(sum(timed.values()), 3),
        "unit": "sec", "queries": timed, "sf": os.path.basename(folder.rstrip("/"))}))


if __name__ == "__main__":
    main()
