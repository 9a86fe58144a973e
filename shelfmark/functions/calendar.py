"""Crawl dates and the calendar attributes derived from them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The season of each month, January first.
SEASON_BY_MONTH = ("WINTER", "WINTER", "SPRING", "SPRING", "SPRING", "SUMMER",
                   "SUMMER", "SUMMER", "AUTUMN", "AUTUMN", "AUTUMN", "WINTER")


def crawl_date(scraped_at: Column) -> Column:
    """The UTC date of an ISO-8601 crawl stamp; null when it is not one.

    A stamp names an instant; its date must not depend on the session's time zone.
    """
    return F.to_date(F.to_utc_timestamp(F.try_to_timestamp(scraped_at), F.current_timezone()))


def season_of(month: Column) -> Column:
    """The season of a month number, null outside 1 to 12."""
    seasons = F.array(*(F.lit(s) for s in SEASON_BY_MONTH))
    return F.try_element_at(seasons, F.nullif(month.cast("int"), F.lit(0)))


def calendar_columns(date: Column) -> list[Column]:
    """day, ISO week, month, quarter, season, year."""
    return [
        F.dayofmonth(date).alias("day"),
        F.weekofyear(date).alias("week"),
        F.month(date).alias("month"),
        F.quarter(date).alias("quarter"),
        season_of(F.month(date)).alias("season"),
        F.year(date).alias("year"),
    ]
