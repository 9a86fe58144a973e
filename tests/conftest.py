from __future__ import annotations

import copy
import json

import pytest

from shelfmark import vocabularies as voc
from shelfmark.session import build_session

BRANDS = {
    "segments": ["Designer", "Denim", "Streetwear"],
    "tiers": ["Luxury", "Premium"],
    "brands": {
        "Saint Laurent": {"segment": "Designer", "tier": "Luxury", "aliases": ["YSL"]},
        "Acne Studios": {"segment": "Designer", "tier": "Premium", "aliases": ["Acne"]},
        "Alaïa": {"segment": "Designer", "tier": "Luxury"},
        "032c": {"segment": "Streetwear", "tier": "Premium"},
    },
}
CATEGORIES = {
    "categories": {
        "Shoes": {"aliases": ["Sneakers", "Boots"]},
        "T-Shirts": {"aliases": ["Tees", "Polos"]},
        "Tops": {"aliases": ["Polos", "Blouses"]},
    },
}


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "shelfmark-tests", **{
            "spark.master": "local[4]",
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.driver.memory": "4g",
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
        })
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def vocabularies(spark):
    return voc.load_vocabularies(spark, BRANDS, CATEGORIES)


STAMP = "2026-08-30T09:14:02Z"


def product(pid, vendor="Saint Laurent", **more):
    body = {
        "id": pid, "title": f"  Product   {pid} ", "vendor": vendor,
        "product_type": "Sneakers", "tags": ["mens", "new in"],
        "options": [{"name": "Color", "position": 1, "values": ["red ", "Blue"]},
                    {"name": " SIZE ", "position": 2, "values": ["38", "39"]}],
        "variants": [
            {"id": f"{pid}-1", "sku": "A 1", "option1": "red", "option2": "38",
             "option3": None, "price": "80.00", "compare_at_price": "100.00",
             "available": True},
            {"id": f"{pid}-2", "sku": "", "option1": "Blue", "option2": "39",
             "option3": None, "price": "0.00", "compare_at_price": None,
             "available": False},
        ],
    }
    body.update(more)
    return body


def document(site="kiosk", stamp=STAMP, products=None, **more):
    products = products if products is not None else {
        "1": product("1"), "2": product("2", "acne-studios", tags=["womens", "Men's"]),
        "3": product("3", "Unknown Maker"), "4": product("4", "032C", variants=None),
    }
    ids = list(products)
    tally = {}
    for body in products.values():
        if body.get("vendor"):
            tally[body["vendor"]] = tally.get(body["vendor"], 0) + 1
    raw = {
        "site": site, "adapter": "feed", "base_url": f"https://{site}.example",
        "currency": "EUR", "country": "Italia", "brand_override": None, "scraped_at": stamp,
        "products_received": len(ids) + 1, "products_stored": len(ids), "vendors": tally,
        "complete": True, "pages": 2, "short_pages": 1, "collections_crawled": 1,
        "listings": [
            {"label": "*unfiltered*", "pages_fetched": 1, "stopped_reason": "empty_page",
             "short_pages": [1], "new_products": len(ids)},
            {"label": "all", "pages_fetched": 1, "stopped_reason": "empty_page",
             "short_pages": [], "new_products": 0}],
        "errors": [], "throttled": 0, "rate_limit_start": 1.0, "rate_limit_final": 1.0,
        "responses": [
            {"listing": "*unfiltered*", "page": 1, "url": "u", "count": len(ids),
             "product_ids": ids},
            {"listing": "all", "page": 1, "url": "u", "count": 1, "product_ids": ids[:1]}],
        "products": products,
    }
    raw.update(more)
    return raw


def write_document(folder, raw, name=None):
    stamp = raw["scraped_at"].replace(":", "").replace("-", "")
    path = folder / (name or f"{raw['site']}-{stamp}.json")
    path.write_text(json.dumps(copy.deepcopy(raw), indent=2, ensure_ascii=False),
                    encoding="utf-8")
    return path
