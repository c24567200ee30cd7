"""Pre-aggregated purchase lines.

Three compact tables replace repeated passes over the lines. Each is one hash aggregate that
combines before its shuffle, so a customer with a large part of all lines reaches the shuffle as
already merged groups:

* day cube: customer x day x campaign. Everything that depends on a line only through its date.
  It is aggregated before the calendar join, so the fan-out multiplies days, not lines.
* item cube: customer x campaign x item. Variety, segment rates and modal items.
* price cube: customer x campaign. Means and deviations of unit prices. The spend cube holds the same
  groups with size, mean and variance of every price, from which customer totals can be pooled too.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from offerwise.functions.scalars import date_parts, day_ordinal, year_month
from offerwise.operators.campaigns import campaign_window_join

# Outputs of the price cube: name -> (column, aggregate).
PRICE_AGGS = {
    "sp_qty_mean": ("sp_qty", "mean"),
    "sp_qty_std": ("sp_qty", "std"),
    "coup_dis_qty_mean": ("coup_dis_qty", "mean"),
    "coup_dis_qty_std": ("coup_dis_qty", "std"),
    "cdis_p_std": ("cdis_p", "std"),
}
_AGGREGATES = {"mean": F.avg, "std": F.stddev_samp}


def _coupon_rows() -> Column:
    return F.sum("coup_yes").alias("n_coup")


def day_cube(lines: DataFrame, campaign: DataFrame) -> DataFrame:
    """Rows and coupon rows per customer, day and campaign window."""
    days = lines.groupBy("customer_id", "date").agg(F.count("*").alias("n"), _coupon_rows())
    windowed = campaign_window_join(days, campaign)
    day = F.col("date")
    parts = date_parts(day, "t") | {"YMon": year_month(day), "date_ord": day_ordinal(day)}
    return windowed.withColumns(parts)


def item_cube(w: DataFrame) -> DataFrame:
    """Rows, coupon rows and newest days per customer, campaign and item with its attributes.

    Attributes belong to the item, so they do not make the groups finer.
    """
    keys = ("customer_id", "camp_ord", "item_id", "brand", "brand_type", "category")
    ordinal = day_ordinal(F.col("date"))
    return w.groupBy(*keys).agg(
        F.count("*").alias("n"),
        _coupon_rows(),
        F.max(ordinal).alias("newest"),
        F.max(F.when(F.col("coup_yes") == 1, ordinal)).alias("newest_coup"),
    )


def price_cube(
    w: DataFrame, aggs: Mapping[str, tuple[str, str]] = PRICE_AGGS, where: Column | None = None
) -> DataFrame:
    """Means and sample deviations per customer and campaign, optionally of some rows only."""
    pick = F.col if where is None else (lambda c: F.when(where, F.col(c)))
    return w.groupBy("customer_id", "camp_ord").agg(
        *[_AGGREGATES[how](pick(c)).alias(out) for out, (c, how) in aggs.items()]
    )


# Prices and amounts of the spend cube.
SPEND = ("sp_qty", "other_dis_qty", "coup_dis_qty", "tot_dis_qty", "pp_qty", "dis_p", "cdis_p", "quantity")


def spend_cube(w: DataFrame) -> DataFrame:
    """Rows, discount uses and the size, mean and variance of every price per customer and campaign."""
    return w.groupBy("customer_id", "camp_ord").agg(
        F.count("*").alias("n"),
        _coupon_rows(),
        F.sum("other_yes").alias("n_other"),
        F.min("quantity").alias("quantity_min"),
        F.max("quantity").alias("quantity_max"),
        *[
            x
            for p in SPEND
            for x in (
                F.count(p).alias(f"{p}_n"),
                F.avg(p).alias(f"{p}_avg"),
                F.var_pop(p).alias(f"{p}_var"),
            )
        ],
    )


def prices_of(spend: DataFrame) -> DataFrame:
    """Price cube columns from the spend cube."""

    def column(p: str, how: str) -> Column:
        if how == "mean":
            return F.col(f"{p}_avg")
        n = F.col(f"{p}_n")
        return F.when(n > 1, F.sqrt(F.col(f"{p}_var") * n / (n - 1)))

    return spend.select(
        "customer_id", "camp_ord", *[column(p, how).alias(out) for out, (p, how) in PRICE_AGGS.items()]
    )


def count_cells(day: DataFrame, *grid: str) -> DataFrame:
    """Rows and coupon rows per customer and grid column, from the day cube."""
    return day.groupBy("customer_id", *grid).agg(F.sum("n").alias("n"), F.sum("n_coup").alias("n_coup"))


def variety_cells(item: DataFrame) -> DataFrame:
    """Rows, distinct items and distinct brands per customer and campaign, from the item cube.

    The cube has one row per item there, so only the brands need a distinct count.
    """
    return item.groupBy("customer_id", "camp_ord").agg(
        F.sum("n").alias("n"),
        F.count("item_id").alias("item_uniq"),
        F.count_distinct("brand").alias("brand_uniq"),
    )


def segment_cells(cube: DataFrame, segment: str) -> DataFrame:
    """Rows and coupon rows per customer, campaign and segment code."""
    return (
        cube.where(F.col(segment).isNotNull())
        .groupBy("customer_id", "camp_ord", segment)
        .agg(F.sum("n").alias("n"), F.sum("n_coup").alias("n_coup"))
    )
