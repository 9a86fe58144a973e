"""Prices and discounts, in decimals throughout."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: a steeper discount than this is a data-entry artifact.
MAX_DISCOUNT_PERCENT = 95

MONEY_TYPE = "decimal(12,2)"
DISCOUNT_TYPE = "decimal(20,2)"


def positive(amount: Column) -> Column:
    """Null out amounts that are zero or below."""
    return F.when(amount > 0, amount)


def money(text: Column) -> Column:
    """Money from text. A malformed price is null rather than a failed job."""
    return positive(text.try_cast(MONEY_TYPE))


def sale_reference_price(price: Column, compare_at: Column, *,
                         keep_boundary: bool = True) -> Column:
    """``compare_at`` where it states a believable sale, else null.

    A discount of exactly ``MAX_DISCOUNT_PERCENT`` is kept by default;
    ``keep_boundary=False`` rejects it.
    """
    floor = compare_at * F.lit(Decimal(100 - MAX_DISCOUNT_PERCENT) / 100)
    believable = price >= floor if keep_boundary else price > floor
    return F.when((compare_at > price) & believable, compare_at)


def discount_percent(price: Column, original: Column) -> Column:
    """Percent off ``original``, half-up to two digits; null when not on sale."""
    return F.round((original - price) / original * 100, 2).cast(DISCOUNT_TYPE)
