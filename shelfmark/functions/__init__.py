"""Column functions: every one takes and returns Spark columns, no UDFs."""

from .arrays import one_of
from .calendar import calendar_columns, crawl_date, season_of
from .money import discount_percent, money, positive, sale_reference_price
from .options import (
    COLOR_OPTIONS,
    GENDER_OPTIONS,
    MATERIAL_OPTIONS,
    SIZE_OPTIONS,
    in_slot,
    listed,
    options_by_role,
)
from .stamps import (
    base_name,
    compact_stamp,
    dataset_of,
    is_stamp,
    retailer_of_file,
    stamp_of_file,
)
from .text import clean_text, fold, upper_name

__all__ = [
    "COLOR_OPTIONS", "GENDER_OPTIONS", "MATERIAL_OPTIONS", "SIZE_OPTIONS",
    "base_name", "calendar_columns", "clean_text", "compact_stamp", "crawl_date",
    "dataset_of", "discount_percent", "fold", "in_slot", "is_stamp", "listed", "money",
    "one_of", "options_by_role", "positive", "retailer_of_file", "sale_reference_price",
    "season_of", "stamp_of_file", "upper_name",
]
