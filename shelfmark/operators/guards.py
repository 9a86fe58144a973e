"""Preconditions: each raises before any work is done on unsound input."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..local import stated_rows


class InputError(ValueError):
    """The input does not allow the run."""


def require_rows(**tables: DataFrame) -> None:
    """Refuse to derive anything from empty tables."""
    empty = [name for name, frame in tables.items() if frame.isEmpty()]
    if empty:
        raise InputError(f"no rows in: {', '.join(empty)}")


def require_single_crawl(frame: DataFrame, stamp: str = "scraped_at") -> str:
    """The one crawl stamp of ``frame``; anything but exactly one is an error."""
    # Distinct per task first; the driver sees one row per stamp, three at most.
    stamps = sorted(str(r[0]) for r in frame.select(stamp).distinct().limit(3).collect())
    if not stamps:
        raise InputError("no crawl in the input")
    if len(stamps) > 1:
        raise InputError(f"expected one crawl, found several stamps: {', '.join(stamps)}")
    return stamps[0]


def select_sites(sites: DataFrame, names: Sequence[str] | None = None, *,
                 include_disabled: bool = False) -> DataFrame:
    """The enabled sites, or the named ones whether enabled or not.

    ``sites`` holds ``name`` and ``enabled``. A name no site carries is an error.
    """
    if not names:
        return sites if include_disabled else sites.where("enabled")
    wanted = stated_rows(sites.sparkSession, ["name"], [(n,) for n in names])
    unknown = sorted(r[0] for r in wanted.join(sites, "name", "left_anti").collect())
    if unknown:
        raise InputError(f"unknown site(s): {', '.join(unknown)}")
    return sites.where(F.col("name").isin(*names))


def require_datasets(listing: DataFrame, expected: Iterable[str]) -> None:
    """Every expected dataset holds at least one file. ``listing``: dataset, files."""
    held = {r[0] for r in listing.where(F.col("files") > 0).select("dataset").collect()}
    missing = sorted(set(expected) - held)
    if missing:
        raise InputError(f"no files for dataset(s): {', '.join(missing)}")
