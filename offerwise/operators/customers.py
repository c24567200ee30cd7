"""Customer features besides the trajectories: summary, recency, last purchases, usual values."""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from offerwise.functions.scalars import ratio
from offerwise.functions.stats import clean, moments
from offerwise.operators.ordering import top_n_per_group

CUSTOMER = "customer_id"

# The last day of the training period, as day of the year, and that year.
REF_DAY = 184
REF_YEAR = 2013

# Unit prices summarised by mean and deviation.
_PRICES = ("sp_qty", "other_dis_qty", "coup_dis_qty", "tot_dis_qty", "pp_qty", "dis_p", "cdis_p")


def _mean_std(name: str, source: str | None = None) -> list[Column]:
    c = F.col(source or name)
    return [F.avg(c).alias(f"{name}_mean"), F.stddev_samp(c).alias(f"{name}_std")]


def _span(name: str, source: str | None = None) -> list[Column]:
    c = F.col(source or name)
    return [F.min(c).alias(f"{name}_min"), F.max(c).alias(f"{name}_max"), *_mean_std(name, source)]


def spending_summary(w: DataFrame) -> DataFrame:
    """All per-customer aggregates that need no distinct count, in one combining pass."""
    return w.groupBy(CUSTOMER).agg(
        F.sum("coup_yes").alias("total_coup_used"),
        F.count("coup_yes").alias("total_trans"),
        F.sum("other_yes").alias("total_other_coup_used"),
        *_mean_std("YMon"),
        *_mean_std("t_dwk"),
        *_span("t_d"),
        *_span("qty", "quantity"),
        *[c for p in _PRICES for c in _mean_std(p)],
    )


def pooled_summary(spend: DataFrame, day: DataFrame) -> DataFrame:
    """The columns of :func:`spending_summary`, from the spend cube and the day cube.

    Saves a pass over the lines. Group means and variances are pooled around the customer's mean,
    which a window over the customer's few campaigns or days provides, so nothing cancels out.
    """
    whole = Window.partitionBy(CUSTOMER)

    def around(n: str, avg: str) -> Column:
        total = F.sum(F.col(n) * F.col(avg)).over(whole)
        return ratio(total, F.sum(n).over(whole))

    def pooled(out: str, n: Column, mean: Column, squares: Column) -> list[Column]:
        size = F.sum(n)
        return [
            F.max(mean).alias(f"{out}_mean"),
            F.when(size > 1, F.sqrt(F.sum(squares) / (size - 1))).alias(f"{out}_std"),
        ]

    c = F.col
    names = {p: p for p in _PRICES} | {"quantity": "qty"}
    prices = spend.withColumns({f"{p}_all": around(f"{p}_n", f"{p}_avg") for p in names})
    by_price = prices.groupBy(CUSTOMER).agg(
        F.sum("n_coup").alias("total_coup_used"),
        F.sum("n").alias("total_trans"),
        F.sum("n_other").alias("total_other_coup_used"),
        F.min("quantity_min").alias("qty_min"),
        F.max("quantity_max").alias("qty_max"),
        *[
            x
            for p, out in names.items()
            for x in pooled(
                out,
                c(f"{p}_n"),
                c(f"{p}_all"),
                c(f"{p}_n") * (c(f"{p}_var") + (c(f"{p}_avg") - c(f"{p}_all")) * (c(f"{p}_avg") - c(f"{p}_all"))),
            )
        ],
    )
    days = ("YMon", "t_dwk", "t_d")
    dated = day.withColumns({f"{d}_all": around("n", d) for d in days})
    by_day = dated.groupBy(CUSTOMER).agg(
        F.min("t_d").alias("t_d_min"),
        F.max("t_d").alias("t_d_max"),
        *[
            x
            for d in days
            for x in pooled(d, c("n"), c(f"{d}_all"), c("n") * (c(d) - c(f"{d}_all")) * (c(d) - c(f"{d}_all")))
        ],
    )
    return by_price.join(by_day, CUSTOMER, "left")


def variety_columns(kind: Column, n_coup: Column) -> list[Column]:
    """Aggregates over ``value_table`` rows: values per kind, of all rows and of coupon rows."""
    used = {"item_id": "item", "brand": "brand", "category": "categ"}
    return [F.count_if(kind == k).alias(f"unique_{'item' if k == 'item_id' else k}") for k in used] + [
        F.count_if((kind == k) & (n_coup > 0)).alias(f"unq_{x}_coup_used") for k, x in used.items()
    ]


def variety_summary(values: DataFrame) -> DataFrame:
    """Distinct items, brands and categories per customer, of all rows and of coupon rows."""
    return values.groupBy(CUSTOMER).agg(*variety_columns(F.col("kind"), F.col("n_coup")))


def customer_summary(w: DataFrame, item: DataFrame) -> DataFrame:
    """The 32 summary columns, the 3 coupon varieties and the 6 ratios."""
    both = spending_summary(w).join(variety_summary(value_table(item)), CUSTOMER, "left")
    return with_ratios(both)


def with_ratios(summary: DataFrame) -> DataFrame:
    """Variety per purchased line and coupon-use shares, null on a zero denominator."""
    pairs = {
        "cust_item_uniq_p": ("unique_item", "total_trans"),
        "cust_brand_uniq_p": ("unique_brand", "total_trans"),
        "cust_categ_uniq_p": ("unique_category", "total_trans"),
        "cust_coup_used_p": ("total_coup_used", "total_trans"),
        "cust_other_coup_used_p": ("total_other_coup_used", "total_trans"),
        "cust_coupvsother_used_p": ("total_coup_used", "total_other_coup_used"),
    }
    return summary.withColumns(
        {out: ratio(F.col(a).cast("double"), F.col(b)) for out, (a, b) in pairs.items()}
    )


def recency(rows: DataFrame, year: int = REF_YEAR, ref_day: int = REF_DAY) -> DataFrame:
    """Days from the last purchase and the last coupon purchase of ``year`` to ``ref_day``.

    ``rows`` is either windowed lines or the day cube; customers without a row in that year are
    null in both columns.
    """
    coupon = F.col("n_coup") > 0 if "n_coup" in rows.columns else F.col("coup_yes") == 1
    this_year = F.when(F.col("t_yr") == year, F.col("t_d"))
    return rows.groupBy(CUSTOMER).agg(
        (F.lit(ref_day) - F.max(F.when(coupon, this_year))).alias("last_coup_days"),
        (F.lit(ref_day) - F.max(this_year)).alias("last_trans_day"),
    )


def newest_first(w: DataFrame) -> list[Column]:
    """Newest day first, then campaign, then everything that tells two lines apart.

    Files keep no row order in Spark, so the order within a day is by content.
    """
    ties = ("camp_ord", "item_id", "order_id", "line_no", "store_id", "quantity", "selling_price")
    return [F.desc("date"), *[F.asc(c) for c in ties if c in w.columns]]


# Output prefix of the last-n columns -> source column; "level" families also summarise the values.
LAST_DIFFS = {
    "Q": "quantity",
    "SP": "sp_qty",
    "ODIS": "other_dis_qty",
    "CDIS": "coup_dis_qty",
    "DISP": "dis_p",
}
LAST_LEVELS = ("SP", "ODIS", "CDIS", "DISP")
LAST_UNIQUE = {"I_uniq": "item_id", "B_uniq": "brand", "C_uniq": "category"}


def _summary_columns(prefixes: Sequence[str]) -> list[Column]:
    return [c.alias(f"{p}_{s}") for p in prefixes for s, c in clean(f"_{p}").items()]


def last_purchases(
    w: DataFrame,
    n: int = 10,
    diffs: Sequence[str] = tuple(LAST_DIFFS),
    levels: Sequence[str] = LAST_LEVELS,
    unique: Sequence[str] = tuple(LAST_UNIQUE),
) -> DataFrame:
    """Statistics over the n newest coupon lines of each customer.

    At most n rows per customer and task reach the shuffle, and everything after it works on at
    most n rows per customer, so the distinct counts may use sets.
    """
    newest = top_n_per_group(w.where(F.col("coup_yes") == 1), [CUSTOMER], newest_first(w), n)
    sequence = Window.partitionBy(CUSTOMER).orderBy("rn")
    steps = newest.withColumns(
        {f"_d{p}": F.col(LAST_DIFFS[p]) - F.lag(LAST_DIFFS[p]).over(sequence) for p in diffs}
    )
    sums = steps.groupBy(CUSTOMER).agg(
        *[F.size(F.collect_set(LAST_UNIQUE[u])).cast("bigint").alias(u) for u in unique],
        *[m for p in diffs for m in moments(F.col(f"_d{p}"), f"_{p}Diff")],
        *[m for p in levels for m in moments(F.col(LAST_DIFFS[p]), f"_{p}")],
    )
    return sums.select(CUSTOMER, *unique, *_summary_columns([*[f"{p}Diff" for p in diffs], *levels]))


def last_days(day: DataFrame, n: int = 10) -> DataFrame:
    """Gaps between the n newest distinct coupon days, newest first, so all gaps are negative."""
    days = day.where(F.col("n_coup") > 0).select(CUSTOMER, "date_ord").distinct()
    newest = top_n_per_group(days, [CUSTOMER], [F.desc("date_ord")], n)
    sequence = Window.partitionBy(CUSTOMER).orderBy("rn")
    gaps = newest.withColumn("_d", F.col("date_ord") - F.lag("date_ord").over(sequence))
    sums = gaps.groupBy(CUSTOMER).agg(*moments(F.col("_d"), "_TDiff"))
    return sums.select(CUSTOMER, *_summary_columns(["TDiff"]))


def mode_per_group(df: DataFrame, keys: Sequence[str], value: str, order: Sequence[Column], out: str) -> DataFrame:
    """Most frequent non-null value; a tie goes to the value whose first row comes first.

    ``order`` are expressions of which the smallest tuple is the first row. Counts combine per
    (group, value) before any row of the group meets another, so a hot group is harmless.
    """
    # A single expression stays a plain column, so that the counting can hash.
    first = order[0] if len(order) == 1 else F.struct(*[c.alias(f"o{i}") for i, c in enumerate(order)])
    counted = (
        df.where(F.col(value).isNotNull())
        .groupBy(*keys, value)
        .agg(F.count("*").alias("_n"), F.min(first).alias("_first"))
    )
    best = F.min_by(F.col(value), F.struct((-F.col("_n")).alias("n"), F.col("_first").alias("f")))
    return counted.groupBy(*keys).agg(best.alias(out))


# Usual values: output stem -> column of the cube that holds it.
DAY_MODES = {"YMon": "YMon", "t_mon": "t_mon", "t_wk": "t_wk", "t_dwk": "t_dwk"}
ITEM_MODES = {"brand": "brand", "category": "category", "item_id": "item_id"}


def _mode_columns(outputs: dict[str, str]) -> list[Column]:
    """Winners per kind for all rows (MC...) and coupon rows (MC...dis).

    Over rows of kind, value, n, place, n_coup, place_coup. More rows win, then the value whose
    first row comes first, which is the one with the larger place.
    """
    out = []
    for kind, cast in outputs.items():
        for suffix, tail in (("", ""), ("_coup", "dis")):
            rank = F.struct(f"n{suffix}", f"place{suffix}")
            taken = F.when((F.col("kind") == kind) & (F.col(f"n{suffix}") > 0), rank)
            out.append(F.max_by("value", taken).cast(cast).alias(f"MC{kind}{tail}"))
    return out


def _value_rows(cube: DataFrame, kinds: dict[str, str], cast: str, place: Column, place_coup: Column) -> DataFrame:
    """Cube to one row per customer, kind and distinct non-null value, with row counts and places."""
    pairs = [F.struct(F.lit(k).alias("kind"), F.col(c).cast(cast).alias("value")) for k, c in kinds.items()]
    return (
        cube.select(
            CUSTOMER, "n", "n_coup", place.alias("_p"), place_coup.alias("_c"), F.explode(F.array(*pairs)).alias("_v")
        )
        .where(F.col("_v.value").isNotNull())
        .groupBy(CUSTOMER, "_v.kind", "_v.value")
        .agg(
            F.sum("n").alias("n"),
            F.max("_p").alias("place"),
            F.sum("n_coup").alias("n_coup"),
            F.max(F.when(F.col("n_coup") > 0, F.col("_c"))).alias("place_coup"),
        )
    )


def day_modes(day: DataFrame) -> DataFrame:
    """Usual month, week and weekday per customer. Two different values never share a day."""
    place = F.col("date_ord")
    values = _value_rows(day, DAY_MODES, "bigint", place, place)
    return values.groupBy(CUSTOMER).agg(*_mode_columns({k: "bigint" for k in DAY_MODES}))


def _place(newest: str) -> Column:
    """Newer days first, then smaller items, as one number.

    A decimal keeps the aggregate on fixed-width buffers, which hashing needs; a struct would make
    Spark sort all rows before they combine.
    """
    days = F.col(newest).cast("decimal(18,0)") * F.lit(Decimal(2**64))
    return (days - F.col("item_id").cast("decimal(20,0)")).cast("decimal(38,0)")


def value_table(item: DataFrame) -> DataFrame:
    """Item cube to one row per customer and distinct item, brand or category, as text.

    Carries the row counts and the place of the value's first row in newest-first order. That row is
    on the value's newest day and there the line with the smallest item, since all lines of a day
    fall into the same campaigns.
    """
    return _value_rows(item, ITEM_MODES, "string", _place("newest"), _place("newest_coup"))


def item_modes(item: DataFrame, variety: bool = False) -> DataFrame:
    """Usual brand, category and item per customer, on request with the distinct counts."""
    types = dict(item.dtypes)
    modes = _mode_columns({k: types[c] for k, c in ITEM_MODES.items()})
    counts = variety_columns(F.col("kind"), F.col("n_coup")) if variety else []
    return value_table(item).groupBy(CUSTOMER).agg(*counts, *modes)
