"""Coupon features from the coupon-to-item mapping."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from offerwise.functions.codes import BRAND_TYPES, CATEGORIES
from offerwise.functions.scalars import one_hot, ratio
from offerwise.operators.joins import lookup
from offerwise.sources.staging import stage

COUPON = "coupon_id"


def add_items(mapping: DataFrame, item: DataFrame, max_rows: int | None = None) -> DataFrame:
    """Mapping rows with the attributes of their item."""
    return lookup(mapping, item, ["item_id"], "left", max_rows)


def coupon_cube(ci: DataFrame) -> DataFrame:
    """Mapping rows per coupon, brand, brand type and category, with the smallest item.

    One combining pass over the mapping serves every coupon feature. A coupon with very many items
    arrives as its few combinations.
    """
    return ci.groupBy(COUPON, "brand", "brand_type", "category").agg(
        F.count("*").alias("n"), F.min("item_id").alias("first_item")
    )


def coupon_summary(cube: DataFrame) -> DataFrame:
    """Distinct and total brands and categories of a coupon's items, with their ratios."""
    sums = cube.groupBy(COUPON).agg(
        F.count_distinct("brand").alias("coup_brand_uniq"),
        F.sum(F.when(F.col("brand").isNotNull(), F.col("n")).otherwise(0)).alias("coup_brand_cnt"),
        F.count_distinct("category").alias("coup_categ_uniq"),
        F.sum(F.when(F.col("category").isNotNull(), F.col("n")).otherwise(0)).alias("coup_categ_cnt"),
    )
    return sums.withColumns(
        {
            f"coup_{x}_uniq_p": ratio(F.col(f"coup_{x}_uniq").cast("double"), F.col(f"coup_{x}_cnt"))
            for x in ("brand", "categ")
        }
    )


def _most_common(cube: DataFrame, value: str, out: str) -> DataFrame:
    """Value with the most items; ties go to the value with the smallest item."""
    counted = (
        cube.where(F.col(value).isNotNull())
        .groupBy(COUPON, value)
        .agg(F.sum("n").alias("_n"), F.min("first_item").alias("_first"))
    )
    rank = F.struct("_n", F.negative("_first").alias("_f"))
    return counted.groupBy(COUPON).agg(F.max_by(value, rank).alias(out))


def coupon_mode(cube: DataFrame, categories: Sequence[str] = CATEGORIES) -> DataFrame:
    """Most common brand and category; the category also one-hot."""
    brand = _most_common(cube, "brand", "MCCoupbrand")
    category = _most_common(cube, "category", "MCCoupcategory_c")
    both = cube.select(COUPON).distinct().join(brand, COUPON, "left").join(category, COUPON, "left")
    return both.withColumns(one_hot(F.col("MCCoupcategory_c"), categories, "MCCoupcategory_"))


def coupon_category_counts(cube: DataFrame, categories: Sequence[str] = CATEGORIES) -> DataFrame:
    """Items per category, 0 where a coupon has none."""
    wide = cube.groupBy(COUPON).pivot("category", list(categories)).agg(F.sum("n")).fillna(0)
    return wide.withColumnsRenamed({x: f"{x}_cnt" for x in categories})


def coupon_breadth(
    cube: DataFrame,
    categories: Sequence[str] = CATEGORIES,
    brand_types: Sequence[str] = BRAND_TYPES,
) -> DataFrame:
    """Per category the number of brand types it comes in, per brand type whether it occurs.

    One distinct over (coupon, brand type, category) instead of a distinct count per output.
    """
    kinds = cube.select(COUPON, "brand_type", "category").distinct()
    per_category = one_hot(F.col("category"), categories, "")
    per_type = one_hot(F.col("brand_type"), brand_types, "")
    return kinds.groupBy(COUPON).agg(
        *[F.sum(c).alias(f"Coup_category_{x}_ohesum") for x, c in per_category.items()],
        *[F.max(c).cast("bigint").alias(f"Coup_brand_type_{x}_ohesum") for x, c in per_type.items()],
    )


def coupon_table(mapping: DataFrame, item: DataFrame, categories: Sequence[str] = CATEGORIES) -> DataFrame:
    """All coupon features, one row per coupon of the mapping."""
    cube = stage(coupon_cube(add_items(mapping, item)), "coupon-cube")
    table = coupon_summary(cube)
    for part in (
        coupon_mode(cube, categories),
        coupon_category_counts(cube, categories),
        coupon_breadth(cube, categories),
    ):
        table = table.join(part, COUPON, "left")
    return table
