"""The crawl trace: what each page of each listing delivered, in crawl order.

Frames used here, all keyed by ``CRAWL``:

* responses  ``seq, listing, page, count, product_ids``
* deliveries ``seq, pos, listing, product_id``, one row per id on a page
* listings   ``ix, label, pages_fetched, stopped_reason, short_pages, new_products``
* bodies     ``product_id, vendor``, one row per stored product
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .dedupe import first_per_key
from .running import sum_before

CRAWL = ("site", "scraped_at")

# Labels and reasons a crawl writes, and when it gives up on the tail.
UNFILTERED = "*unfiltered*"
ENDED = "empty_page"
PAGE_SIZE = 250
TAIL_PATIENCE = 5
TAIL_MIN_NEW = 25
PAGE_BUDGET = 4000
MULTI_BRAND_ABOVE = 3


def deliveries(responses: DataFrame) -> DataFrame:
    return responses.select(
        *CRAWL, "seq", "listing", F.posexplode("product_ids").alias("pos", "product_id"))


def first_deliveries(delivered: DataFrame, crawl: Sequence[str] = CRAWL,
                     order: Sequence[str] = ("seq", "pos")) -> DataFrame:
    """The first delivery of every product id: overlapping listings made one set."""
    return first_per_key(delivered, [*crawl, "product_id"], order)


def listing_yield(delivered: DataFrame, crawl: Sequence[str] = CRAWL,
                  order: Sequence[str] = ("seq", "pos")) -> DataFrame:
    """Per listing: ids it delivered, and ids nothing earlier had delivered.

    Both come from one pass: an id's deliveries by one listing are first reduced to
    their earliest, then the listing that had it earliest is credited.
    """
    crawl = list(crawl)
    rank = F.struct(*order) if len(order) > 1 else F.col(order[0])
    by_listing = (delivered.groupBy(*crawl, "listing", "product_id")
                  .agg(F.min(rank).alias("_at"), F.count(F.lit(1)).alias("_times")))
    credited = (first_per_key(by_listing, [*crawl, "product_id"], ["_at"])
                .groupBy(*crawl, "listing").agg(F.count(F.lit(1)).alias("new_products")))
    return (
        by_listing.groupBy(*crawl, "listing").agg(F.sum("_times").alias("delivered"))
        .join(credited, [*crawl, "listing"], "left")
        .select(*crawl, "listing", "delivered",
                F.coalesce("new_products", F.lit(0)).cast("long").alias("new_products"))
    )


def tail_cutoff(listings: DataFrame, crawl: Sequence[str] = CRAWL, position: str = "ix", *,
                guaranteed: int | Column = 0, patience: int | None = TAIL_PATIENCE,
                min_new: int = TAIL_MIN_NEW, page_budget: int | None = PAGE_BUDGET,
                ) -> DataFrame:
    """Mark which listings a crawl would walk: adds ``walked`` and ``tail_end``.

    Past the ``guaranteed`` positions a crawl stops once ``patience`` listings in a
    row each add fewer than ``min_new`` products, or once the pages fetched reach
    ``page_budget``. ``position`` numbers the listings of a crawl without gaps. The
    listing that completes the streak is walked.

    A streak is found by counting, for each position, the barren listings among the
    ``patience`` last ones, so it needs no sequential pass. Either rule is left out by
    passing ``None``.
    """
    crawl = list(crawl)
    guaranteed = F.lit(guaranteed) if isinstance(guaranteed, int) else guaranteed
    listings = listings.withColumn("_tail", F.col(position) >= guaranteed)

    marked, walked = listings, F.lit(True)
    if patience is not None:
        barren = listings.where(F.col("_tail") & (F.col("new_products") < min_new))
        streaks = (
            barren.select(*crawl, F.explode(F.sequence(
                F.col(position), F.col(position) + (patience - 1))).alias("_end"))
            .groupBy(*crawl, "_end").agg(F.count(F.lit(1)).alias("_n"))
            .where(F.col("_n") == patience)
            .groupBy(*crawl).agg(F.min("_end").alias("_streak_end"))
        )
        marked = marked.join(streaks, crawl, "left")
        walked = F.col("_streak_end").isNull() | (F.col(position) <= F.col("_streak_end"))
    if page_budget is not None:
        counted = sum_before(listings, crawl, position, F.col("pages_fetched"), "_pages")
        spent = (counted.where(F.col("_tail") & (F.col("_pages") >= page_budget))
                 .groupBy(*crawl).agg(F.min(position).alias("_budget_end")))
        marked = marked.join(spent, crawl, "left")
        walked = walked & (F.col("_budget_end").isNull()
                           | (F.col(position) < F.col("_budget_end")))
    names = [c for c in listings.columns if c != "_tail"]
    return marked.select(*names, F.col("_tail").alias("tail"), walked.alias("walked"))


def crawl_counters(responses: DataFrame, listings: DataFrame,
                   bodies: DataFrame) -> DataFrame:
    """Every summary number of a crawl, recomputed from what it holds."""
    paged = responses.groupBy(*CRAWL).agg(
        F.sum("count").alias("products_received"), F.count(F.lit(1)).alias("pages"))
    listed = listings.groupBy(*CRAWL).agg(
        F.sum(F.size(F.coalesce("short_pages", F.array().cast("array<bigint>"))))
        .alias("short_pages"),
        F.count_if(~F.col("label").eqNullSafe(UNFILTERED)).alias("collections_crawled"),
        F.every(F.col("stopped_reason").eqNullSafe(ENDED)).alias("complete"))
    stored = bodies.groupBy(*CRAWL).agg(F.count(F.lit(1)).alias("products_stored"))
    joined = (paged.join(listed, list(CRAWL), "full_outer")
              .join(stored, list(CRAWL), "full_outer"))
    counters = ("products_received", "products_stored", "pages", "short_pages",
                "collections_crawled")
    return joined.select(
        *CRAWL, *(F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in counters),
        F.coalesce("complete", F.lit(True)).alias("complete"))


def vendor_tally(bodies: DataFrame, crawl: Sequence[str] = CRAWL) -> DataFrame:
    """Stored products per vendor; a missing or empty vendor is not counted."""
    named = bodies.where(F.col("vendor").isNotNull() & (F.col("vendor") != ""))
    return named.groupBy(*crawl, "vendor").agg(F.count(F.lit(1)).alias("products"))


def brand_shape(bodies: DataFrame, crawl: Sequence[str] = CRAWL) -> DataFrame:
    """Whether a store sells one brand or many, by its distinct vendors."""
    vendors = vendor_tally(bodies, crawl).groupBy(*crawl).agg(
        F.count(F.lit(1)).alias("vendors"))
    return vendors.withColumn("shape", F.when(F.col("vendors") > MULTI_BRAND_ABOVE,
                                              "multi-brand").otherwise("single-brand"))


def stop_reasons(listings: DataFrame, crawl: Sequence[str] = CRAWL) -> DataFrame:
    """How many listings of a crawl were cut off, by reason."""
    cut = listings.where(~F.col("stopped_reason").eqNullSafe(ENDED))
    return cut.groupBy(*crawl, "stopped_reason").agg(F.count(F.lit(1)).alias("listings"))


def collections_worth_walking(collections: DataFrame) -> DataFrame:
    """Collections with a handle and at least one product."""
    return collections.where(F.col("handle").isNotNull() & (F.col("handle") != "")
                             & (F.col("products_count") > 0))
