"""Trajectory features: how a customer's purchases moved from campaign to campaign.

Each family is a measure on a grid, summarised over the grid row or over its neighbour differences.
All requested families share one cell table and therefore one shuffle on the customer.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from offerwise.functions.codes import CATEGORIES
from offerwise.functions.scalars import ratio
from offerwise.operators.cubes import (
    PRICE_AGGS,
    count_cells,
    day_cube,
    item_cube,
    price_cube,
    segment_cells,
    variety_cells,
)
from offerwise.operators.grids import (
    COUNT,
    SHARE,
    VALUE,
    Family,
    Single,
    melt,
    slot_of,
    trajectory_stats,
    union_cells,
    widen,
)
from offerwise.sources.staging import stage

# Suffix of the count measures -> grid.
GRIDS = {"": ("camp_ord",), "_wk": ("camp_ord", "t_wk"), "_dwk": ("camp_ord", "t_dwk")}
_THREE = ("min", "max", "std")


def _count_families() -> dict[str, tuple[Family, ...]]:
    out = {}
    for suffix, trips, share in (("", "TT", "CT"), ("_wk", "wkT", "wkCT"), ("_dwk", "wkdT", "wkdCT")):
        out[f"trip_change{suffix}"] = (Family(f"{trips}diff", f"trips{suffix}", "diff"),)
        out[f"coupon_share{suffix}"] = (Family(share, f"coupon_share{suffix}"),)
        out[f"coupon_share_change{suffix}"] = (Family(f"{share}diff", f"coupon_share{suffix}", "diff"),)
    return out


def _price_families(coupon_only: bool) -> dict[str, tuple[Family | Single, ...]]:
    """``TT_`` families of all rows and their ``CT_`` twins.

    The twins are defined over all rows as well: they repeat the ``TT_`` cells. The twin of the
    price deviation has no mean and instead carries the last grid column and the last difference,
    which its other differences leave out. ``coupon_only`` restricts the twins to coupon rows and
    gives that one the usual shape.
    """
    out: dict[str, tuple[Family | Single, ...]] = {}
    for m in PRICE_AGGS:
        out[f"{m}_all"] = (Family(f"TT_{m}", m), Family(f"TT_{m}diff", m, "diff"))
        twin = f"{m}_coupon" if coupon_only else m
        out[f"{m}_coupon"] = (Family(f"CT_{m}", twin), Family(f"CT_{m}diff", twin, "diff"))
    if not coupon_only:
        out["sp_qty_std_coupon"] = (
            Family("CT_sp_qty_std", "sp_qty_std", "level", _THREE),
            Family("CT_sp_qty_stddiff", "sp_qty_std", "tail", _THREE),
            Single("CT_sp_qty_std_last_camp", "sp_qty_std", "tail_value"),
            Single("CT_sp_qty_stddiff_last_camp", "sp_qty_std", "tail_step"),
        )
    return out


def families(quirks: str = "original", categories: Sequence[str] = CATEGORIES) -> dict[str, tuple[Family | Single, ...]]:
    """All families by name. ``quirks`` is "original" or "clean" (see ``_price_families``)."""
    out: dict[str, tuple[Family | Single, ...]] = dict(_count_families())
    out["item_variety"] = (Family("TT_uniq_item_p", "item_variety"),)
    out["brand_variety"] = (Family("TT_uniq_brand_p", "brand_variety"),)
    out |= _price_families(quirks == "clean")
    out["coupon_rate_by_campaign_type"] = tuple(Family(f"TT_coup_yes_camp{k}_mean", f"camp{k}") for k in (0, 1))
    out["coupon_rate_by_brand_type"] = tuple(Family(f"TT_coup_yes_brand{k}_mean", f"brand{k}") for k in (0, 1))
    out["coupon_rate_by_category"] = tuple(
        Single(f"TT_coup_yes_cat{k}_mean_mean", f"cat{k}", "level_avg") for k in range(len(categories))
    )
    return out


def kind_of(measure: str) -> str:
    if measure.startswith("trips"):
        return COUNT
    return SHARE if measure.startswith("coupon_share") else VALUE


def _coupon_rate(cells: DataFrame, prefix: str, segment: str) -> DataFrame:
    """Coupon rate per segment as long cells, one measure per segment code."""
    measure = F.concat(F.lit(prefix), F.col(segment).cast("string"))
    rate = ratio(F.col("n_coup").cast("double"), F.col("n"))
    return cells.select("customer_id", F.col("camp_ord").cast("bigint").alias("slot"), measure.alias("measure"), rate.alias("v"))


def build_cells(
    measures: set[str],
    day: DataFrame | None = None,
    item: DataFrame | None = None,
    price: DataFrame | None = None,
    price_coupon: DataFrame | None = None,
) -> DataFrame:
    """Long cells of the wanted measures; only the cubes those need have to be given."""
    camp = F.col("camp_ord").cast("bigint")
    parts = []
    for suffix, grid in GRIDS.items():
        names = {
            f"trips{suffix}": F.col("n"),
            f"coupon_share{suffix}": ratio(F.col("n_coup").cast("double"), F.col("n")),
        }
        wanted = {m: c for m, c in names.items() if m in measures}
        if wanted:
            parts.append(melt(count_cells(day, *grid), wanted, slot_of(grid)))
    variety = {
        "item_variety": ratio(F.col("item_uniq").cast("double"), F.col("n")),
        "brand_variety": ratio(F.col("brand_uniq").cast("double"), F.col("n")),
    }
    wanted = {m: c for m, c in variety.items() if m in measures}
    if wanted:
        parts.append(melt(variety_cells(item), wanted, camp))
    for cube, suffix in ((price, ""), (price_coupon, "_coupon")):
        wanted = {f"{m}{suffix}": F.col(m) for m in PRICE_AGGS if f"{m}{suffix}" in measures}
        if wanted:
            parts.append(melt(cube, wanted, camp))
    for prefix, segment, cube in (
        ("camp", "campaign_type", day),
        ("brand", "brand_type", item),
        ("cat", "category", item),
    ):
        if any(m.startswith(prefix) and m[len(prefix) :].isdigit() for m in measures):
            parts.append(_coupon_rate(segment_cells(cube, segment), prefix, segment))
    return union_cells([p.select("customer_id", "measure", "slot", "v") for p in parts])


def summarise(cells: DataFrame, chosen: Sequence[Family | Single], form: str = "cumulative") -> DataFrame:
    """Customer rows with the chosen families' columns.

    The cells are staged: they are read once for the list of slots and once for the statistics, and
    neither should repeat the pass over the lines.
    """
    kinds = {m: kind_of(m) for m in measures_of(chosen)}
    return widen(trajectory_stats(stage(cells, "cells"), kinds, form), chosen)


def measures_of(chosen: Sequence[Family | Single]) -> set[str]:
    return {m for f in chosen for m, _ in f.columns().values()}


def campaign_trajectory(
    lines: DataFrame,
    windowed: DataFrame,
    campaign: DataFrame,
    name: str,
    stats: str = "cumulative",
    quirks: str = "original",
    categories: Sequence[str] = CATEGORIES,
) -> DataFrame:
    """One family by name, straight from the lines and their windowed form."""
    chosen = families(quirks, categories)[name]
    measures = measures_of(chosen)

    def any_of(*stems: str) -> bool:
        return any(m.startswith(stems) for m in measures)

    coupon_rows = F.col("coup_yes") == 1
    cells = build_cells(
        measures,
        day=day_cube(lines, campaign) if any_of("trips", "coupon_share", "camp") else None,
        item=item_cube(windowed) if any_of("item_", "brand", "cat") else None,
        price=price_cube(windowed) if any_of(*PRICE_AGGS) else None,
        price_coupon=price_cube(windowed, where=coupon_rows) if quirks == "clean" else None,
    )
    return summarise(cells, chosen, stats)


def segment_rate(windowed: DataFrame, segment: str, prefix: str, codes: Sequence[int], stats: str = "cumulative") -> DataFrame:
    """Coupon rate per campaign within each segment code, summarised per customer."""
    cells = windowed.groupBy("customer_id", "camp_ord", segment).agg(
        F.count("*").alias("n"), F.sum("coup_yes").alias("n_coup")
    )
    chosen = [Family(f"{prefix}{k}_mean", f"{prefix}{k}") for k in codes]
    rates = _coupon_rate(cells.where(F.col(segment).isin(list(codes))), prefix, segment)
    return summarise(rates, chosen, stats)
