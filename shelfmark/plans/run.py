"""One run: a raw crawl to the twelve processed tables."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from ..operators.lookup import unmatched_preview
from ..quality import processed
from ..quality.findings import together
from ..schemas import ddl
from ..session import cut_lineage
from ..sources import raw
from ..sources.tables import REPLACE, TableStore
from ..vocabularies import Vocabulary
from . import conform

REPORTED = (("vendor", "brands"), ("product_type", "categories"))


@dataclass
class RunReport:
    rows: dict[str, int] = field(default_factory=dict)
    # vocabulary -> (values added, values in all)
    vocabularies: dict[str, tuple[int, int]] = field(default_factory=dict)
    # column -> (most frequent unmatched values, whether there are more)
    unmatched: dict[str, tuple[list[tuple[str, int]], bool]] = field(default_factory=dict)
    # findings on the columns of all tables, from the pass that wrote them
    findings: DataFrame | None = None


def shred_run(spark: SparkSession, raw_path: str, shredded_path: str) -> raw.Shredded:
    """Parse every document once and keep its flat rows."""
    raw.require_documents(spark, raw_path)
    shredded = raw.shred(raw.read_documents(spark, raw_path), raw.read_bodies(spark, raw_path))
    raw.write_shredded(shredded, shredded_path)
    return raw.read_shredded(spark, shredded_path)


def conform_run(shredded: raw.Shredded, vocabularies: Mapping[str, Vocabulary],
                output: TableStore, *, dry_run: bool = False) -> RunReport:
    """Write the twelve tables of one run; ``dry_run`` counts them and writes nothing."""
    spark = output.spark
    report = RunReport()
    tables: dict[str, DataFrame] = {}
    for vocabulary in vocabularies.values():
        current = vocabulary.table(spark)
        held = output.read_or_empty(vocabulary.name, ddl(current.schema))
        tables[vocabulary.name] = conform.sync_vocabulary(held, current, vocabulary.key)
        report.vocabularies[vocabulary.name] = (held.count(), 0)

    described = conform.described_products(
        shredded.products, vocabularies["brands"], vocabularies["categories"],
        vocabularies["genders"])
    if not dry_run:
        # Both tables are read out of it.
        described = cut_lineage(described)
    tables["crawls"] = conform.crawls(shredded.crawls, vocabularies["currencies"])
    tables["retailers"] = conform.retailers(shredded.crawls, vocabularies["countries"])
    tables["dates"] = conform.dates(shredded.crawls)
    tables["products"] = conform.products(described)
    tables["variants"] = conform.variants(
        shredded.variants, described,
        conform.crawl_currencies(shredded.crawls, vocabularies["currencies"]))

    for column, vocabulary in REPORTED:
        report.unmatched[column] = unmatched_preview(
            shredded.products, column, vocabularies[vocabulary])

    load = output.begin()
    for name, frame in tables.items():
        if dry_run:
            report.rows[name] = frame.count()
        else:
            report.rows[name] = load.write(
                name, frame, REPLACE, files=1 if name in vocabularies else None,
                measures=processed.write_measures(name, frame.columns))
    if not dry_run:
        load.commit()
        report.findings = together(processed.written_checks(
            spark, name, tables[name].columns, load.observed[name]) for name in tables)
    for name, (before, _) in report.vocabularies.items():
        total = report.rows[name]
        report.vocabularies[name] = (total - before, total)
    return report
