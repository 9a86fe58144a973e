"""The star schema: ten dimensions and the observation fact.

All dimensions are derived together: the natural keys of every processed table are
tagged rows of one frame, made distinct once and numbered once. Held rows keep their
surrogate keys. Processed columns and keys meet on equality, so a null never matches.
``new_*`` return only the rows to append.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.keys import dense_keys, highest_key, interleaved_keys
from ..operators.merge import new_rows
from ..schemas import PROCESSED
from ..session import cut_lineage

FACT_KEYS = ("variant_id", "product_id", "retailer_key", "date_key")
PRODUCT_KEYS = ("product_id", "retailer_key", "date_key")
# A dimension whose rows hold no more is sent to every task of a join.
BROADCAST_BYTES = 32 << 20


@dataclass(frozen=True)
class Dimension:
    """What a dimension is made of; its natural key is the grain of its table.

    ``links`` name the columns that hold another dimension's natural key. ``updated``
    dimensions take the newest attributes (Type 1), others keep the first.
    """

    key: str
    table: str
    attributes: tuple[str, ...] = ()
    links: Mapping[str, str] = field(default_factory=dict)
    updated: bool = False

    @property
    def natural(self) -> str:
        return PROCESSED[self.table].grain[0]


DIMENSIONS = {spec.dimension: Dimension(f"{spec.dimension[4:]}_key", name)
              for name, spec in PROCESSED.items() if spec.dimension} | {
    "dim_country": Dimension("country_key", "countries", ("name",)),
    "dim_date": Dimension("date_key", "dates", tuple(
        c for c in PROCESSED["dates"].columns if c != "date")),
    "dim_brand": Dimension("brand_key", "brands", links={
        "segment": "dim_segment", "tier": "dim_tier"}, updated=True),
    "dim_retailer": Dimension("retailer_key", "retailers", ("url",),
                              {"country": "dim_country"}, updated=True)}


def _tagged(name: str, rows: DataFrame) -> DataFrame:
    """``dimension, natural, stated``: a processed table's rows, attributes as JSON."""
    one = DIMENSIONS[name]
    stated = [F.col(c) for c in (*one.attributes, *one.links)]
    return rows.select(
        F.lit(name).alias("dimension"), F.col(one.natural).cast("string").alias("natural"),
        (F.to_json(F.struct(*stated)) if stated else F.lit("{}")).alias("stated"))


def dimensions(held: Mapping[str, DataFrame],
               processed: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """The dimensions as they are after ``processed`` has been loaded into ``held``.

    Dimensions whose table is not among the processed ones stay as they are. Each processed
    table is read once; what follows works on distinct values, kept in the shared folder. Two
    different rows with one key fail an updated dimension, as they would fail a warehouse
    merge; otherwise the lowest is taken.
    """
    loaded = [n for n, one in DIMENSIONS.items() if one.table in processed]
    needed = {*loaded, *(parent for n in loaded for parent in DIMENSIONS[n].links.values())}
    incoming = cut_lineage(reduce(DataFrame.unionByName, (
        _tagged(n, processed[DIMENSIONS[n].table]) for n in loaded))
        .where("natural IS NOT NULL").groupBy("dimension", "natural").agg(
            F.min("stated").alias("stated"), F.max("stated").alias("other")))
    before = reduce(DataFrame.unionByName, (held[n].select(
        F.lit(n).alias("dimension"), F.col(DIMENSIONS[n].natural).cast("string").alias("natural"),
        F.col(DIMENSIONS[n].key).alias("key")) for n in needed))
    fresh = incoming.select("dimension", "natural").join(
        before, ["dimension", "natural"], "left_anti")
    last = before.groupBy("dimension").agg(F.max("key").alias("last"))
    numbered = dense_keys(fresh, "key", ["natural"], within=["dimension"]).join(
        F.broadcast(last), "dimension", "left").select(       # a row per dimension
        "dimension", "natural", (F.coalesce("last", F.lit(0)) + F.col("key")).alias("key"),
        F.lit(True).alias("added"))
    keys = cut_lineage(numbered.unionByName(before.withColumn("added", F.lit(False))))
    sizes = {row["dimension"]: row["bytes"] for row in keys.groupBy("dimension").agg(
        F.sum(F.octet_length("natural") + 16).alias("bytes")).collect()}

    def keys_of(name: str) -> DataFrame:
        mine = keys.where(F.col("dimension") == name).drop("dimension")
        return F.broadcast(mine) if sizes.get(name, 0) <= BROADCAST_BYTES else mine

    def whole(name: str) -> DataFrame:
        one, before = DIMENSIONS[name], held[name]
        types = dict(before.dtypes)
        stated = ", ".join([f"{c} {types[c]}" for c in one.attributes]
                           + [f"{c} string" for c in one.links])
        rows = incoming.where(F.col("dimension") == name)
        if one.updated:
            rows = rows.withColumn("stated", F.when(
                F.col("stated") == F.col("other"), F.col("stated")).otherwise(F.raise_error(
                    F.lit(f"merge source repeats a key: {name}"))))
        rows = rows.select("natural", F.from_json("stated", stated).alias("s") if stated
                           else F.lit(None).alias("s")).join(keys_of(name), "natural")
        for link, parent in one.links.items():
            rows = rows.withColumn("_link", F.col(f"s.{link}")).join(
                keys_of(parent).select(F.col("natural").alias("_link"),
                                       F.col("key").alias(DIMENSIONS[parent].key)),
                "_link", "left")
        made = rows.where("added" if not one.updated else "true").select(
            *(F.col("natural").cast(types[c]).alias(c) if c == one.natural
              else F.col("key").alias(c) if c == one.key
              else F.col(f"s.{c}").alias(c) if c in one.attributes else F.col(c)
              for c in before.columns))
        kept = before.join(made.select(one.natural), one.natural, "left_anti").select(
            *before.columns) if one.updated else before
        return kept.unionByName(made)

    return {n: small(whole(n), sizes.get(n, 0)) if n in loaded else frame
            for n, frame in held.items()}


def small(frame: DataFrame, size: int) -> DataFrame:
    """Hinted for broadcast when the keys it is joined by are known to be small."""
    return F.broadcast(frame) if size <= BROADCAST_BYTES else frame


def _with_key(rows: DataFrame, dimension: DataFrame, column: str, natural: str,
              key: str, how: str = "left") -> DataFrame:
    # A natural key is unique in its dimension, so this neither drops nor doubles rows.
    keys = dimension.select(F.col(natural).alias(column), key)
    return rows.join(keys, column, how)


def product_observations(products: DataFrame, brands: DataFrame, retailers: DataFrame,
                         categories: DataFrame, genders: DataFrame,
                         dates: DataFrame) -> DataFrame:
    """Processed products with their dimension keys; a value without one leaves null."""
    rows = products.dropna(subset=["product", "retailer", "date"])
    rows = _with_key(rows, brands, "brand", "name", "brand_key")
    rows = _with_key(rows, retailers, "retailer", "name", "retailer_key")
    rows = _with_key(rows, categories, "category", "name", "category_key")
    rows = _with_key(rows, genders, "gender", "name", "gender_key")
    rows = _with_key(rows, dates, "date", "date", "date_key")
    return rows.select(
        F.col("product").alias("product_id"), "name", "brand_key", "retailer_key",
        "category_key", "gender_key", "color", "material", "date_key")


def unresolved_products(observations: DataFrame) -> DataFrame:
    """Observations without a retailer or date key.

    They are reported, not loaded: their key is part of the grain, and a null there
    never matches, so each rerun would insert them again.
    """
    return observations.where(F.col("retailer_key").isNull() | F.col("date_key").isNull())


def new_products(held: DataFrame, observations: DataFrame,
                 date_keys: Sequence[int] | None = None,
                 highest: int | None = None) -> DataFrame:
    """DIM_PRODUCT rows to append: one per product, retailer and date not yet held.

    ``date_keys`` are all that the observations have, where they are known; only those
    partitions of what is held are then read for their keys. ``highest`` is the highest
    key held, where it is known (``TableStore.highest``); else all keys are read for it.
    """
    resolved = observations.dropna(subset=["retailer_key", "date_key"])
    fresh = new_rows(held, resolved, PRODUCT_KEYS, _within(date_keys))
    return interleaved_keys(fresh, "product_key", PRODUCT_KEYS,
                            highest_key(held, "product_key") if highest is None else highest)


def fact_rows(variants: DataFrame, products: DataFrame, retailers: DataFrame,
              dates: DataFrame, currencies: DataFrame) -> DataFrame:
    """Observations at variant grain; brand and category come from the product.

    A variant whose retailer, date or product is not in its dimension is left out.
    """
    rows = variants.dropna(subset=["variant", "product", "retailer", "date"])
    rows = _with_key(rows, retailers, "retailer", "name", "retailer_key", "inner")
    rows = _with_key(rows, dates, "date", "date", "date_key", "inner")
    rows = _with_key(rows, currencies, "currency", "name", "currency_key")
    described = products.select(*PRODUCT_KEYS, "product_key", "brand_key", "category_key")
    return (
        rows.withColumnRenamed("product", "product_id")
        .withColumnRenamed("variant", "variant_id")
        .join(described, list(PRODUCT_KEYS))
        .select("product_id", "variant_id", "product_key", "brand_key", "retailer_key",
                "category_key", "date_key", "sku", "size", "color", "price",
                "original_price", "currency_key", "discount", "available")
    )


def new_facts(held: DataFrame, rows: DataFrame, date_keys: Sequence[int] | None = None,
              held_keys: Sequence[int] | None = None) -> DataFrame:
    """Fact rows to append: the first write of an observation stays.

    ``held_keys`` are all date keys that are held, where they are known; rows of others are
    then not shuffled. ``rows`` are read twice for it, so they should be a table.
    """
    return new_rows(held, rows, FACT_KEYS, _within(date_keys), _within(held_keys))


def _within(date_keys: Sequence[int] | None) -> tuple[str, Sequence[int]] | None:
    return None if date_keys is None else ("date_key", date_keys)
