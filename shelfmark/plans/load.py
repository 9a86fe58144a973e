"""Loading a run: processed tables into the history, and the star schema from it."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.guards import InputError, require_rows
from ..operators.merge import new_rows, values_of
from ..schemas import ANALYTICAL, PROCESSED
from ..session import cut_lineage
from ..sources.tables import APPEND, REPLACE, TableStore
from . import star


def typed(frame: DataFrame, table: str) -> DataFrame:
    """A table's declared columns in their declared types."""
    types = PROCESSED[table].types
    return frame.select(*(F.col(c).cast(t).alias(c) for c, t in types.items()))


def load_processed(run: TableStore, history: TableStore) -> dict[str, int]:
    """Take one run's twelve tables into the history; returns the rows added.

    Vocabularies and retailers are replaced whole. Crawls, dates, products and
    variants are cumulative: rows not yet held are appended, under their date, and
    earlier crawls are neither read (beyond the keys of the dates at hand) nor
    rewritten. Loading a run twice adds nothing.
    """
    missing = sorted(set(PROCESSED) - run.tables())
    if missing:
        raise InputError(f"the run lacks table(s): {', '.join(missing)}")
    load = history.begin()
    added = {}
    for table, spec in PROCESSED.items():
        rows = typed(run.read(table), table)
        if not spec.cumulative:
            added[table] = load.write(table, rows, REPLACE, files=1)
            continue
        held = history.read_or_empty(table, spec.ddl)
        fresh = new_rows(held, rows, spec.grain, ("date", values_of(rows, "date")))
        added[table] = load.write(table, fresh, APPEND, partition_by="date")
    load.commit()
    return added


@dataclass(frozen=True)
class AnalyticalLoad:
    added: dict[str, int]
    unresolved: int


def load_analytical(history: TableStore, model: TableStore,
                    date: str | None = None) -> AnalyticalLoad:
    """Derive the star schema; all of it becomes visible in one commit.

    Dimensions first, then dates, products and facts, as each needs the keys of the
    one before. ``date`` limits products and variants to one crawl; by default every
    crawl held is considered, and those already loaded add nothing.
    """
    processed = {t: history.read_or_empty(t, PROCESSED[t].ddl) for t in PROCESSED}
    require_rows(products=processed["products"], variants=processed["variants"])
    if date is not None:
        for table in ("products", "variants"):
            processed[table] = processed[table].where(F.col("date") == F.lit(date).cast("date"))

    load = model.begin()
    held = {t: model.read_or_empty(t, ddl) for t, ddl in ANALYTICAL.items()}
    added: dict[str, int] = {}

    dims = star.dimensions({n: held[n] for n in star.DIMENSIONS}, processed)
    for table, rows in dims.items():
        before = held[table].count()
        added[table] = load.write(table, rows, REPLACE, files=1) - before

    # Used twice, to report and to load: joined once and kept in the shared folder.
    observed = cut_lineage(star.product_observations(
        processed["products"], dims["dim_brand"], dims["dim_retailer"],
        dims["dim_category"], dims["dim_gender"], dims["dim_date"]))
    unresolved = star.unresolved_products(observed).count()
    # A fact joins its product's row, so its date is among those of the observations.
    date_keys = values_of(observed, "date_key")
    added["dim_product"] = load.write(
        "dim_product", star.new_products(held["dim_product"], observed, date_keys,
                                         model.highest("dim_product", "product_key")), APPEND,
        partition_by="date_key")
    facts = star.fact_rows(processed["variants"], load.pending("dim_product"),
                           dims["dim_retailer"], dims["dim_date"], dims["dim_currency"])
    added["fact_product_observation"] = load.write(
        "fact_product_observation",
        star.new_facts(held["fact_product_observation"], facts, date_keys),
        APPEND, partition_by="date_key")
    load.commit()
    return AnalyticalLoad(added, unresolved)
