"""Declared schemas. Nothing is inferred: inference is a second pass over the data,
and two stores disagree about the type of one field.

A processed table is one StructType. Whether a column may be null, belongs to the grain,
is a name (upper case) or takes its values from a vocabulary is said with the column;
whatever else the engine has to know of a table follows from that.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql.types import (ArrayType, BooleanType, DataType, DateType, DecimalType,
                               DoubleType, IntegerType, LongType, MapType, StringType,
                               StructField, StructType)

TEXT, COUNT, NUMBER, FLAG, RATE, DAY = (StringType(), LongType(), IntegerType(), BooleanType(),
                                        DoubleType(), DateType())
MONEY, PERCENT = DecimalType(12, 2), DecimalType(20, 2)


def record(**fields: DataType) -> StructType:
    return StructType([StructField(name, kind) for name, kind in fields.items()])


def ddl(struct: StructType) -> str:
    return ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in struct.fields)


def _without(struct: StructType, *names: str) -> StructType:
    return StructType([f for f in struct.fields if f.name not in names])


# --- raw documents (fixed values: the names of the fields a crawl writes) --------------

_VARIANT = record(id=TEXT, sku=TEXT, option1=TEXT, option2=TEXT, option3=TEXT, price=TEXT,
                  compare_at_price=TEXT, available=FLAG)
_PRODUCT = record(id=TEXT, title=TEXT, vendor=TEXT, product_type=TEXT, tags=ArrayType(TEXT),
                  options=ArrayType(record(name=TEXT, position=NUMBER, values=ArrayType(TEXT))),
                  variants=ArrayType(_VARIANT))
_LISTING = record(label=TEXT, pages_fetched=COUNT, stopped_reason=TEXT,
                  short_pages=ArrayType(COUNT), new_products=COUNT)
_RESPONSE = record(listing=TEXT, page=COUNT, url=TEXT, count=COUNT, product_ids=ArrayType(TEXT))
_ERROR = record(listing=TEXT, page=COUNT, error=TEXT)

# One document per retailer and crawl. Products and vendors are maps, so their keys
# are data and not columns: two spellings that differ in case stay two entries.
_DOCUMENT = record(
    site=TEXT, adapter=TEXT, base_url=TEXT, currency=TEXT, country=TEXT, brand_override=TEXT,
    scraped_at=TEXT, products_received=COUNT, products_stored=COUNT,
    vendors=MapType(TEXT, COUNT), complete=FLAG, pages=COUNT, short_pages=COUNT,
    collections_crawled=COUNT, listings=ArrayType(_LISTING), errors=ArrayType(_ERROR),
    throttled=COUNT, rate_limit_start=RATE, rate_limit_final=RATE,
    responses=ArrayType(_RESPONSE), products=MapType(TEXT, _PRODUCT))
# What a store may not tell, and how fast it was asked.
_MAY_LACK = ("currency", "country", "brand_override", "throttled", "rate_limit_start",
             "rate_limit_final")
# What is not of the crawl itself.
_HELD = ("vendors", "responses", "products")

PRODUCT, RAW_DOCUMENT = _PRODUCT.simpleString(), ddl(_DOCUMENT)
REQUIRED_FIELDS = _without(_DOCUMENT, *_MAY_LACK).names
CRAWL_FIELDS = _without(_DOCUMENT, *_HELD).names


def _shredded(rows: StructType, **more: DataType) -> str:
    """Flat rows as they are stored, behind them the crawl they are from."""
    crawl = record(**more, scraped_at=TEXT, site=TEXT, stamp=TEXT)
    return ddl(StructType(_without(rows, *crawl.names).fields + crawl.fields))


SHREDDED = {
    "crawls": _shredded(_without(_DOCUMENT, *_HELD),
                        vendors=ArrayType(record(vendor=TEXT, products=COUNT))),
    "products": _shredded(_without(_PRODUCT, "variants")),
    "variants": _shredded(_VARIANT, product_id=TEXT),
}

# --- processed tables ------------------------------------------------------------------

GRAIN, NAME, OPTIONAL = "grain", "name", "optional"


def column(name: str, kind: DataType = TEXT, *roles: str, of: str | None = None) -> StructField:
    """A column and its roles: part of the grain, a name, one that may be null.

    ``of`` names the vocabulary that all values are from; they are names then.
    """
    return StructField(name, kind, OPTIONAL in roles, {
        GRAIN: GRAIN in roles, NAME: NAME in roles or of is not None, "vocabulary": of or ""})


@dataclass(frozen=True)
class Table:
    """A table, and what its columns say of it.

    ``dimension`` is the one it feeds, if any, by its grain.
    """

    struct: StructType
    dimension: str | None = None

    @classmethod
    def of(cls, *columns: StructField, dimension: str | None = None) -> Table:
        return cls(StructType(list(columns)), dimension)

    def _with(self, role: str) -> list[str]:
        return [f.name for f in self.struct.fields if f.metadata[role]]

    @property
    def columns(self) -> list[str]:
        return self.struct.names

    @property
    def types(self) -> dict[str, str]:
        return {f.name: f.dataType.simpleString() for f in self.struct.fields}

    @property
    def ddl(self) -> str:
        return ddl(self.struct)

    @property
    def grain(self) -> list[str]:
        return self._with(GRAIN)

    @property
    def names(self) -> list[str]:
        return self._with(NAME)

    @property
    def filled(self) -> list[str]:
        return [f.name for f in self.struct.fields if not f.nullable]

    @property
    def vocabularies(self) -> dict[str, str]:
        """The vocabulary of each column that has one."""
        return {f.name: v for f in self.struct.fields if (v := f.metadata["vocabulary"])}

    @property
    def cumulative(self) -> bool:
        """Whether loads add to it, by date, or replace it whole."""
        return "date" in self.grain


def _values(dimension: str) -> Table:
    return Table.of(column("name", TEXT, GRAIN, NAME), dimension=dimension)


PROCESSED = {
    "crawls": Table.of(
        column("site", TEXT, GRAIN, NAME), column("base_url"),
        column("currency", of="currencies"), column("name", TEXT, NAME, OPTIONAL),
        column("date", DAY, GRAIN),
        *(column(counter, NUMBER) for counter in (
            "products_received", "products_stored", "pages", "short_pages",
            "collections_crawled"))),
    "retailers": Table.of(
        column("name", TEXT, GRAIN, NAME), column("url"), column("country", of="countries"),
        dimension="dim_retailer"),
    "dates": Table.of(
        column("date", DAY, GRAIN), column("day", NUMBER), column("week", NUMBER),
        column("month", NUMBER), column("quarter", NUMBER), column("season", TEXT, NAME),
        column("year", NUMBER), dimension="dim_date"),
    "products": Table.of(
        column("product", TEXT, GRAIN), column("retailer", TEXT, GRAIN, NAME), column("name"),
        column("brand", of="brands"), column("category", TEXT, OPTIONAL, of="categories"),
        column("gender", TEXT, OPTIONAL, of="genders"), column("color", TEXT, NAME, OPTIONAL),
        column("material", TEXT, NAME, OPTIONAL), column("date", DAY, GRAIN)),
    "variants": Table.of(
        column("variant", TEXT, GRAIN), column("product", TEXT, GRAIN),
        column("retailer", TEXT, GRAIN, NAME), column("date", DAY, GRAIN),
        column("sku", TEXT, OPTIONAL), column("size", TEXT, NAME, OPTIONAL),
        column("color", TEXT, NAME, OPTIONAL), column("price", MONEY, OPTIONAL),
        column("currency", of="currencies"), column("original_price", MONEY, OPTIONAL),
        column("discount", PERCENT, OPTIONAL), column("available", FLAG)),
    "brands": Table.of(column("name", TEXT, GRAIN, NAME), column("segment", TEXT, NAME),
                       column("tier", TEXT, NAME), dimension="dim_brand"),
    "countries": Table.of(column("code", TEXT, GRAIN, NAME), column("name", TEXT, NAME),
                          dimension="dim_country"),
    **{f"{one[:-1]}ies" if one.endswith("y") else f"{one}s": _values(f"dim_{one}")
       for one in ("category", "currency", "gender", "segment", "tier")},
}


ANALYTICAL = {
    "dim_segment": "segment_key bigint, name string",
    "dim_tier": "tier_key bigint, name string",
    "dim_category": "category_key bigint, name string",
    "dim_currency": "currency_key bigint, name string",
    "dim_gender": "gender_key bigint, name string",
    "dim_country": "country_key bigint, code string, name string",
    "dim_brand": "brand_key bigint, name string, segment_key bigint, tier_key bigint",
    "dim_retailer": "retailer_key bigint, name string, url string, country_key bigint",
    "dim_date": "date_key bigint, date date, day int, week int, month int, quarter int, "
                "season string, year int",
    "dim_product": "product_key bigint, product_id string, name string, brand_key bigint, "
                   "retailer_key bigint, category_key bigint, gender_key bigint, "
                   "color string, material string, date_key bigint",
    "fact_product_observation":
        "product_id string, variant_id string, product_key bigint, brand_key bigint, "
        "retailer_key bigint, category_key bigint, date_key bigint, sku string, "
        "size string, color string, price decimal(12,2), original_price decimal(12,2), "
        "currency_key bigint, discount decimal(20,2), available boolean",
}
