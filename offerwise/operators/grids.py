"""Customer x campaign grids, kept long: one row per non-empty cell.

A cell table has the columns customer_id, measure, slot, v. ``slot`` is the cell's column in the
grid: the campaign order, or campaign order and week or weekday packed into one number that sorts
the same way. A customer has at most one cell per measure and slot, so no customer's cells grow with
the number of purchases.

Neighbouring columns are neighbours in the list of slots seen for *any* customer. ``trajectory_stats``
ranks those slots once per measure and compares ranks, so the grid is never filled in.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from offerwise.functions.scalars import ratio
from offerwise.functions.stats import FORMS, STATS, moments
from offerwise.operators.joins import lookup

CUSTOMER = "customer_id"

# How empty cells and missing slots behave.
COUNT = "count"  # an empty cell is 0
SHARE = "share"  # used / all: unused slots stay in the list as nulls, non-users have no value at all
VALUE = "value"  # an empty cell is null, a slot without any value leaves the list

# Second part of a two-part slot and the factor that makes room for it.
_PARTS = {"t_wk": 100, "t_dwk": 10}


def slot_of(grid: Sequence[str]) -> Column:
    """One sortable number for a grid column."""
    if len(grid) == 1:
        return F.col(grid[0]).cast("bigint")
    return F.col(grid[0]).cast("bigint") * _PARTS[grid[1]] + F.col(grid[1])


def melt(cells: DataFrame, measures: Mapping[str, Column], slot: Column) -> DataFrame:
    """Wide cells to one row per measure, empty cells dropped."""
    pairs = [F.struct(F.lit(m).alias("measure"), c.cast("double").alias("v")) for m, c in measures.items()]
    return (
        cells.select(CUSTOMER, slot.alias("slot"), F.explode(F.array(*pairs)).alias("_p"))
        .select(CUSTOMER, "slot", "_p.measure", "_p.v")
        .where(F.col("v").isNotNull())
    )


def count_grid(cells: DataFrame, slots: Sequence[int], suffix: str = "_cnt") -> DataFrame:
    """One row per customer and one column per listed campaign, 0 where the customer has no row."""
    wide = cells.groupBy(CUSTOMER).pivot("camp_ord", list(slots)).agg(F.sum("n")).fillna(0)
    return wide.withColumnsRenamed({str(x): f"{x}{suffix}" for x in slots})


def grid_ratio(num: DataFrame, den: DataFrame, keys: Sequence[str], out: str) -> DataFrame:
    """Cell-wise num.v / den.v on equal keys; a cell absent from ``num`` counts 0 there."""
    pair = den.withColumnRenamed("v", "_den").join(num.withColumnRenamed("v", "_num"), list(keys), "left")
    return pair.select(*keys, ratio(F.coalesce("_num", F.lit(0.0)), F.col("_den")).alias(out))


def _placed(cells: DataFrame, kinds: Mapping[str, str]) -> DataFrame:
    """Cells with the rank of their slot and the number of slots of the measure."""
    slots = cells.groupBy("measure", "slot").agg(F.max("v").alias("_top"))
    by_slot = Window.partitionBy("measure").orderBy("slot")
    ranked = slots.select(
        "measure",
        "slot",
        "_top",
        F.row_number().over(by_slot).alias("pos"),
        F.count("*").over(Window.partitionBy("measure")).alias("last_pos"),
    )
    shares = [m for m, kind in kinds.items() if kind == SHARE]
    placed = lookup(cells, ranked, ["measure", "slot"], "inner")
    if shares:  # nobody used a coupon in this slot: a null column, though it keeps its place
        placed = placed.where(~F.col("measure").isin(shares) | (F.col("_top") > 0))
    return placed.drop("_top", "slot")


def _with_steps(placed: DataFrame, counts: Sequence[str]) -> DataFrame:
    """Differences to the left neighbour column.

    ``x1`` is the difference that ends in this cell, ``x2`` the one that leaves it for an empty
    column, which exists only where empty means 0. All other differences are 0 - 0.
    """
    row = Window.partitionBy(CUSTOMER, "measure").orderBy("pos")
    v, pos = F.col("v"), F.col("pos")
    is_count = F.col("measure").isin(list(counts)) if counts else F.lit(False)
    left = F.when(F.lag("pos").over(row) == pos - 1, F.lag("v").over(row))
    alone = F.coalesce(F.lead("pos").over(row) != pos + 1, F.lit(True))
    return (
        placed.repartition(CUSTOMER)
        .withColumns({"_left": left, "_alone": alone, "_count": is_count})
        .withColumns(
            {
                "x1": F.when(
                    F.col("_count"), F.when(pos > 1, v - F.coalesce("_left", F.lit(0.0)))
                ).otherwise(v - F.col("_left")),
                "x2": F.when(F.col("_count") & F.col("_alone") & (pos < F.col("last_pos")), -v),
            }
        )
    )


def trajectory_stats(cells: DataFrame, kinds: Mapping[str, str], form: str = "cumulative") -> DataFrame:
    """Statistics of each grid row and of its neighbour differences.

    Returns one row per customer and measure with level_*, diff_* and, for the last column of the
    grid, tail_* (differences without the last column, last value, last difference but one).
    One shuffle on the customer serves the window, the aggregate and a later pivot.
    """
    counts = [m for m, kind in kinds.items() if kind == COUNT]
    shares = [m for m, kind in kinds.items() if kind == SHARE]
    steps = _with_steps(_placed(cells, kinds), counts)
    pos, last = F.col("pos"), F.col("last_pos")
    inside = F.when(pos < last, F.col("x1"))
    sums = steps.groupBy(CUSTOMER, "measure").agg(
        *moments(F.col("v"), "level"),
        *moments(F.col("x1"), "diff"),
        *moments(inside, "tail"),
        F.max(F.when(pos == last, F.col("v"))).alias("tail_value"),
        F.max(F.when(pos == last - 1, F.col("x1"))).alias("tail_step"),
        F.first("_count").alias("_count"),
        (F.first("last_pos") - 1).alias("_n"),
        *moments(F.col("x2"), "_away"),
    )
    # Zero-filled rows: the untouched differences are zeros. Arrivals, departures and zeros are three
    # groups whose variances are pooled around the common mean, so large counts do not cancel out.
    n = F.col("_n")
    none = F.greatest(n - F.col("diff_n") - F.col("_away_n"), F.lit(0))
    zero = F.when(none > 0, F.lit(0.0))
    parts = [(F.col(f"{p}_n"), *(F.coalesce(f"{p}_{x}", F.lit(0.0)) for x in ("avg", "var"))) for p in ("diff", "_away")]
    sums = sums.withColumn("_mean", ratio(parts[0][0] * parts[0][1] + parts[1][0] * parts[1][1], n))
    mean = F.col("_mean")
    squares = none * mean * mean
    for size, avg, var in parts:
        squares = squares + size * (var + (avg - mean) * (avg - mean))
    dense = {
        "diff_n": n,
        "diff_min": F.least("diff_min", "_away_min", zero),
        "diff_max": F.greatest("diff_max", "_away_max", zero),
        "diff_avg": mean,
        "diff_var": ratio(squares, n),
    }
    sums = sums.withColumns({k: F.when(F.col("_count"), c).otherwise(F.col(k)) for k, c in dense.items()})
    # A customer who never used a coupon has no share row.
    kept = ~F.col("measure").isin(shares) | (F.col("level_max") > 0) if shares else F.lit(True)
    make = FORMS[form]
    wanted = {f"{p}_{s}": c for p in ("level", "diff", "tail") for s, c in make(p).items()}
    wanted |= {x: F.col(x) for x in ("tail_value", "tail_step", "level_avg")}
    return sums.where(kept).select(CUSTOMER, "measure", *[c.alias(k) for k, c in wanted.items()])


@dataclass(frozen=True)
class Family:
    """Output columns of one grid: ``prefix_{min,max,mean,std}`` of the level or the differences."""

    prefix: str
    measure: str
    part: str = "level"
    stats: tuple[str, ...] = STATS

    def columns(self) -> dict[str, tuple[str, str]]:
        """Output name -> (measure, column of trajectory_stats)."""
        return {f"{self.prefix}_{s}": (self.measure, f"{self.part}_{s}") for s in self.stats}


@dataclass(frozen=True)
class Single:
    """One output column taken from one column of trajectory_stats."""

    name: str
    measure: str
    source: str

    def columns(self) -> dict[str, tuple[str, str]]:
        return {self.name: (self.measure, self.source)}


def widen(stats: DataFrame, families: Iterable[Family | Single]) -> DataFrame:
    """One row per customer with the families' columns.

    ``stats`` has one row per customer and measure, so the map gathers a fixed number of entries. A
    pivot would build every measure times every statistic, most of which no family uses. Each measure
    is looked up in the map once; its columns are then taken by place.
    """
    wanted = {k: v for f in families for k, v in f.columns().items()}
    sources = sorted({s for _, s in wanted.values()})
    place = {m: i for i, m in enumerate(dict.fromkeys(m for m, _ in wanted.values()))}
    entry = F.struct("measure", F.struct(*sources))
    rows = stats.groupBy(CUSTOMER).agg(F.map_from_entries(F.collect_list(entry)).alias("_m"))
    measures = F.array(*[F.lit(m) for m in place])
    rows = rows.select(CUSTOMER, F.transform(measures, lambda m: F.col("_m")[m]).alias("_a"))
    return rows.selectExpr(CUSTOMER, *[f"_a[{place[m]}].{s} as `{out}`" for out, (m, s) in wanted.items()])


def union_cells(parts: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)
