"""Purchase lines with their item attributes, dates, flags and unit prices."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from offerwise.functions.codes import BRAND_TYPES, CATEGORIES
from offerwise.functions.scalars import (
    date_parts,
    encode,
    unit_prices,
    used_flag,
    year_day,
    year_month,
)
from offerwise.operators.joins import lookup


def add_items(lines: DataFrame, item: DataFrame, max_rows: int | None = None) -> DataFrame:
    """Left join the item dimension; a line of an unknown item keeps null attributes."""
    return lookup(lines, item, ["item_id"], "left", max_rows)


def describe_lines(lines: DataFrame, categories: Sequence[str] = CATEGORIES) -> DataFrame:
    """Derived columns of a purchase line that already carries its item; one narrow projection."""
    day = F.col("date")
    new = date_parts(day, "t") | {
        "YMon": year_month(day),
        "Yday": year_day(day),
        "other_yes": used_flag(F.col("other_discount")),
        "coup_yes": used_flag(F.col("coupon_discount")),
        "category": encode(F.col("category"), categories),
        "brand_type": encode(F.col("brand_type"), BRAND_TYPES),
    }
    return unit_prices(lines.withColumns(new))
