"""Controlled vocabularies: which spellings mean which canonical value.

A vocabulary is configuration, written by hand and held by the driver. It reaches
the data as a small DataFrame ``(folded, canonical)`` to join with, and as a table
of its canonical values and their attributes.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions.text import fold
from .local import stated_rows

# The vocabularies small enough to be stated here. Brands and
# categories are parameters, read with ``read_definition``.
SEGMENTS = ["Luxury House", "Designer", "Contemporary Designer", "Streetwear",
            "Sportswear", "Outdoor", "Casual", "High Street", "Denim", "Basics"]
TIERS = ["High Luxury", "Luxury", "Premium", "Mainstream"]
CURRENCIES = ["USD", "EUR", "GBP", "SEK"]
GENDERS = {
    "Men": {"aliases": ["Man", "Mens", "Men's", "Male", "Menswear", "Uomo"]},
    "Women": {"aliases": ["Woman", "Womens", "Women's", "Female", "Womenswear",
                          "Ladies", "Donna"]},
    "Kids": {"aliases": ["Kid", "Children", "Child", "Boys", "Girls", "Junior",
                         "Baby", "Bambino"]},
    "Unisex": {"aliases": ["Uni", "All Genders"]},
}
COUNTRIES = {
    "US": {"name": "United States",
           "aliases": ["USA", "U.S.", "U.S.A.", "United States",
                       "United States of America"]},
    "GB": {"name": "United Kingdom",
           "aliases": ["UK", "U.K.", "United Kingdom", "Great Britain", "England"]},
    "IT": {"name": "Italy", "aliases": ["Italy", "Italia"]},
    "FR": {"name": "France", "aliases": ["France"]},
    "DE": {"name": "Germany", "aliases": ["Germany", "Deutschland"]},
    "NL": {"name": "Netherlands",
           "aliases": ["Netherlands", "The Netherlands", "Holland", "Nederland"]},
    "SE": {"name": "Sweden", "aliases": ["Sweden", "Sverige"]},
    "AT": {"name": "Austria", "aliases": ["Austria", "Osterreich", "Österreich"]},
    "ES": {"name": "Spain", "aliases": ["Spain", "Espana", "España"]},
    "DK": {"name": "Denmark", "aliases": ["Denmark", "Danmark"]},
    "BE": {"name": "Belgium", "aliases": ["Belgium", "Belgie", "België", "Belgique"]},
    "HU": {"name": "Hungary", "aliases": ["Hungary", "Magyarorszag", "Magyarország"]},
}

SEVERAL_GENDERS = "UNISEX"


class VocabularyError(ValueError):
    """A vocabulary definition that would produce wrong values."""


@dataclass(frozen=True)
class Vocabulary:
    """One vocabulary. ``lookup`` holds folded spelling -> canonical value."""

    name: str
    rows: list[dict[str, str | None]]
    lookup: dict[str, str]
    key: str = "name"
    # Folded spellings claimed by two canonical values: (spelling, lost, kept).
    collisions: tuple[tuple[str, str, str], ...] = ()

    @property
    def columns(self) -> list[str]:
        seen = {self.key: None}
        for row in self.rows:
            seen.update(dict.fromkeys(row))
        return list(seen)

    def spellings(self, spark: SparkSession) -> DataFrame:
        """``(folded, canonical)``, one row per folded spelling."""
        return stated_rows(spark, ("folded", "canonical"), self.lookup.items())

    def table(self, spark: SparkSession) -> DataFrame:
        """The canonical values and their attributes."""
        return stated_rows(spark, self.columns,
                           (tuple(row.get(c) for c in self.columns) for row in self.rows))


def build_vocabulary(spark: SparkSession, name: str,
                     definition: Mapping[str, Mapping | None] | Sequence[str], *,
                     key: str = "name", attributes: Sequence[str] = ()) -> Vocabulary:
    """A vocabulary from ``{canonical: {aliases, attributes}}`` or a bare list.

    A canonical value is always one of its own spellings. Where two values claim
    one folded spelling, the later one has it and the clash is kept in ``collisions``.
    """
    if key in attributes:
        raise VocabularyError(f"{name}: attribute {key!r} would overwrite the key")
    given = dict(definition if isinstance(definition, Mapping) else dict.fromkeys(definition))
    if odd := [value for value in given if not isinstance(value, str)]:
        raise VocabularyError(f"{name}: {', '.join(map(repr, odd))} is not text; quote it")
    if not given:
        return Vocabulary(name, [], {}, key)

    stated = _stated(spark, given, attributes)
    values = stated.select(F.upper("canonical").alias(key),
                           *(F.upper(a).alias(a) for a in attributes))
    claims = _claims(stated).collect()
    return Vocabulary(
        name, [row.asDict() for row in values.collect()],
        {row["folded"]: row["canonical"] for row in claims}, key,
        tuple(sorted((row["folded"], lost, row["canonical"])
                     for row in claims for lost in row["others"])))


def _stated(spark: SparkSession, given: Mapping[str, Mapping | None],
            attributes: Sequence[str]) -> DataFrame:
    """``at, canonical, aliases`` and attributes, a row per entry of a definition.

    As local rows: the optimizer evaluates what follows from them without a job, or with
    a small one.
    """
    text = lambda value: None if value is None else str(value)
    rows = [(at, canonical, [str(alias) for alias in (body or {}).get("aliases") or ()],
             *(text((body or {}).get(a)) for a in attributes))
            for at, (canonical, body) in enumerate(given.items())]
    return stated_rows(spark, {
        "at": pa.int64(), "canonical": pa.string(), "aliases": pa.list_(pa.string()),
        **dict.fromkeys(attributes, pa.string())}, rows)


def _claims(stated: DataFrame) -> DataFrame:
    """``folded, canonical, others``: who has each spelling, and who has lost it."""
    spelled = stated.select("at", F.upper("canonical").alias("canonical"), F.explode(
        F.concat(F.array("canonical"), "aliases")).alias("spelling"))
    by_spelling = spelled.groupBy(fold(F.col("spelling")).alias("folded")).agg(
        F.max_by("canonical", "at").alias("canonical"), F.collect_set("canonical").alias("all"))
    return by_spelling.select("folded", "canonical", F.array_sort(F.array_except(
        "all", F.array("canonical"))).alias("others"))


def build_brands(spark: SparkSession, definition: Mapping[str, Mapping],
                 segments: Vocabulary, tiers: Vocabulary) -> Vocabulary:
    """The brand allowlist: every brand carries a known segment and tier."""
    brands = build_vocabulary(spark, "brands", definition, attributes=("segment", "tier"))
    if brands.rows:
        held = brands.table(spark)
        for attribute, allowed in (("segment", segments), ("tier", tiers)):
            known = allowed.table(spark).select(F.col("name").alias(attribute))
            unknown = held.join(known, attribute, "left_anti").orderBy("name").collect()
            if unknown:
                raise VocabularyError("brands: " + "; ".join(
                    f"{row['name']}: {attribute} {row[attribute]!r} is not known"
                    for row in unknown))
    return brands


def read_definition(path: str | Path) -> dict:
    """A definition file, JSON or YAML."""
    text = Path(path).read_text(encoding="utf-8")
    if str(path).endswith(".json"):
        return json.loads(text)
    try:
        import yaml
    except ImportError as error:  # pragma: no cover - depends on the installation
        raise VocabularyError(f"{path}: reading YAML needs PyYAML; use JSON") from error
    return yaml.safe_load(text) or {}


def load_vocabularies(spark: SparkSession, brands: Mapping,
                      categories: Mapping) -> dict[str, Vocabulary]:
    """The seven vocabularies, given the brand and the category document.

    ``brands`` holds the blocks ``segments``, ``tiers`` and ``brands``;
    ``categories`` the block ``categories``. ``segments`` and ``tiers`` default to
    the ones stated in this module.
    """
    segments = build_vocabulary(spark, "segments", brands.get("segments") or SEGMENTS)
    tiers = build_vocabulary(spark, "tiers", brands.get("tiers") or TIERS)
    vocabularies = [
        build_brands(spark, brands.get("brands") or {}, segments, tiers),
        segments,
        tiers,
        build_vocabulary(spark, "categories", categories.get("categories") or {}),
        build_vocabulary(spark, "genders", GENDERS),
        build_vocabulary(spark, "countries", COUNTRIES, key="code", attributes=("name",)),
        build_vocabulary(spark, "currencies", CURRENCIES),
    ]
    return {v.name: v for v in vocabularies}
