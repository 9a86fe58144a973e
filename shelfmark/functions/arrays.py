"""Arrays of raw values resolved to one."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from zlib import crc32

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import fold_elements


def spelled_as(mapping: Mapping[str, str]) -> Callable[[Column], Column]:
    """A lookup of folded spellings whose cost does not grow with their number.

    The spellings stand in small maps by a checksum, all in one literal: a value is looked
    for in the one map it can be in.
    """
    size = len(mapping) // 2 + 1
    buckets: list[list] = [[] for _ in range(size)]
    for spelling, canonical in mapping.items():
        buckets[crc32(spelling.encode()) % size] += [F.lit(spelling), F.lit(canonical)]
    none = F.create_map().cast("map<string, string>")
    table = F.array(*(F.create_map(*pairs) if pairs else none for pairs in buckets))

    def find(value: Column) -> Column:
        bucket = F.get(table, (F.crc32(value.cast("binary")) % size).cast("int"))
        return F.try_element_at(bucket, value)

    return find


def one_of(values: Column, mapping: Mapping[str, str], several: str, *,
           strip_prefix: bool = False) -> Column:
    """Resolve an array of raw values to one canonical value.

    None recognised gives null, one distinct gives that one, more give
    ``several``. ``strip_prefix`` drops a leading ``key:`` from each value first,
    so ``Gender: Women`` reads as ``Women``. Thousands of spellings cost a row no more than a
    few; for a vocabulary that is a table, ``operators.lookup.resolve_arrays`` joins.
    """
    if not mapping:
        return F.lit(None).cast("string")
    if strip_prefix:
        values = F.transform(values, lambda v: F.regexp_replace(v, r"^[^:]*:", ""))
    folded = F.array_distinct(fold_elements(values))
    found = F.array_distinct(F.array_compact(F.transform(folded, spelled_as(mapping))))
    return bound(found, lambda f: F.when(F.size(f) > 1, F.lit(several)).otherwise(F.get(f, 0)))


def bound(value: Column, fn: Callable[[Column], Column]) -> Column:
    """``fn`` of a costly value that it refers to more than once, evaluated once."""
    return F.get(F.transform(F.array(value), fn), 0)
