"""Ordered operators: top n, neighbours, positions, folds.

A window keyed by customer puts each customer's rows into one task. That is right for almost every
customer and wrong for one who holds a large part of the table, so the operators that must see a
whole ordered group treat such hot groups apart.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from offerwise.operators.joins import lookup, small_side
from offerwise.sources.staging import stage

# A group of this many rows still sorts comfortably in one task.
HOT_ROWS = 2_000_000


def top_n_per_group(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int, rank: str = "rn", label: str = ""
) -> DataFrame:
    """First n rows of each group with their running number.

    The rank limit is applied before the shuffle as well, so a group sends at most n rows per task.
    """
    numbered = df.withColumn(rank, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    top = numbered.where(F.col(rank) <= n)
    return top.withColumn(f"{rank}_label", F.concat(F.lit(label), F.col(rank))) if label else top


def lag_diff(df: DataFrame, keys: Sequence[str], order: Sequence[Column], cols: Mapping[str, str]) -> DataFrame:
    """Difference to the previous row of the group, for groups already cut to a bounded size."""
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumns({out: F.col(c) - F.lag(c).over(window) for out, c in cols.items()})


def hot_groups(df: DataFrame, key: str, hot_rows: int) -> DataFrame:
    """Key values with more than ``hot_rows`` rows: at most rows / hot_rows of them."""
    return df.groupBy(key).count().where(F.col("count") > hot_rows).select(key)


def _neighbour(col: str, offset: int, window) -> Column:
    """Value ``offset`` rows back (positive) or ahead (negative)."""
    return F.lag(col, offset).over(window) if offset > 0 else F.lead(col, -offset).over(window)


def _shifts_within_group(df, key, order, cols):
    window = Window.partitionBy(key).orderBy(*order)
    return df.withColumns({out: _neighbour(c, k, window) for out, (c, k) in cols.items()})


def _shifts_across_tasks(df, key, order, cols):
    """Neighbours inside groups that are cut into range partitions.

    Rows are range-partitioned by (key, order). Inside a piece every neighbour is found locally but
    for the first and last few rows. Those edge rows, a bounded number per piece, form a sequence in
    which any two rows that are neighbours across a cut are neighbours too, so a second window over
    the edges alone completes them.
    """
    reach = max(abs(k) for _, k in cols.values())
    pieces = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cut = df.repartitionByRange(pieces, F.col(key), *order).withColumn("_piece", F.spark_partition_id())

    inner = Window.partitionBy("_piece", key).orderBy(*order)
    local = {f"_in_{out}": _neighbour(c, k, inner) for out, (c, k) in cols.items()}
    local["_head"] = F.row_number().over(inner) <= reach
    local["_tail"] = F.lead(F.lit(1), reach).over(inner).isNull()
    found = cut.withColumns(local)

    edge = F.when(F.col("_head") | F.col("_tail"), -1).otherwise(F.col("_piece"))
    outer = Window.partitionBy(key, "_seam").orderBy(*order)
    joined = found.withColumn("_seam", edge).withColumns(
        {
            out: F.when(F.col("_head" if k > 0 else "_tail"), _neighbour(c, k, outer)).otherwise(
                F.col(f"_in_{out}")
            )
            for out, (c, k) in cols.items()
        }
    )
    return joined.drop("_piece", "_seam", *local)


def shifts(
    df: DataFrame,
    key: str,
    specs: Sequence[tuple[Sequence[Column], Mapping[str, tuple[str, int]]]],
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Previous and next values per group, for several orders at once.

    ``specs`` pairs an order, total within the group, with {output: (column, offset)}; a positive
    offset looks back. All orders share one shuffle on ``key``. Groups above ``hot_rows`` go through
    a range-partitioned path that never holds a whole group in a task.
    """

    def run(rows, step):
        for order, cols in specs:
            rows = step(rows, key, list(order), cols)
        return rows

    hot = stage(hot_groups(df, key, hot_rows), "hot-groups")
    if hot.isEmpty():
        return run(df, _shifts_within_group)
    columns = df.columns + [out for _, cols in specs for out in cols]
    cold_rows = run(lookup(df, hot, [key], "left_anti"), _shifts_within_group)
    hot_part = run(lookup(df, hot, [key], "left_semi"), _shifts_across_tasks)
    return cold_rows.select(columns).unionByName(hot_part.select(columns))


def group_positions(
    df: DataFrame, key: str, order: Sequence[Column], out: str = "position", hot_rows: int = HOT_ROWS
) -> DataFrame:
    """One-based position of every row in its group. Groups above ``hot_rows`` are numbered by a
    distributed sort, from which the first position of the group is taken off."""
    plain = F.row_number().over(Window.partitionBy(key).orderBy(*order))
    hot = stage(hot_groups(df, key, hot_rows), "hot-groups")
    if hot.isEmpty():
        return df.withColumn(out, plain)
    cold = lookup(df, hot, [key], "left_anti").withColumn(out, plain)
    placed = global_position(lookup(df, hot, [key], "left_semi"), [F.asc(key), *order], "_at").drop("_at_total")
    starts = placed.groupBy(key).agg(F.min("_at").alias("_first"))
    large = lookup(placed, starts, [key], "inner").withColumn(out, (F.col("_at") - F.col("_first") + 1).cast("int"))
    return cold.unionByName(large.select(cold.columns))


def global_position(df: DataFrame, order: Sequence[Column], out: str = "position") -> DataFrame:
    """Zero-based position in a total order, and the row total, without a single-task window.

    A distributed sort numbers the rows inside each partition. The sorted rows are staged so that
    sizes and positions come from the same partitions; only one size per partition is summed up.
    """
    slot = F.monotonically_increasing_id()  # (sorted partition << 33) + row in partition
    placed = stage(df.orderBy(*order).withColumn("_slot", slot), "sorted")
    placed = placed.withColumn("_part", F.shiftright("_slot", 33))
    sizes = placed.groupBy("_part").agg(F.count("*").alias("_size"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        "_part",
        F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_before"),
        F.sum("_size").over(Window.partitionBy(F.lit(0))).alias(f"{out}_total"),
    )
    in_part = F.col("_slot").bitwiseAND(F.lit((1 << 33) - 1))
    numbered = lookup(placed, offsets, ["_part"], "inner")
    return numbered.withColumn(out, F.col("_before") + in_part).drop("_slot", "_part", "_before")


def contiguous_folds(df: DataFrame, k: int, order: Sequence[Column], out: str = "fold") -> DataFrame:
    """Cut the ordered rows into k runs (0-based); the first (rows mod k) runs get one row more."""
    numbered = global_position(df, order, "_pos")
    size, extra = F.floor(F.col("_pos_total") / k), F.col("_pos_total") % k
    long_rows = extra * (size + 1)
    fold = F.when(F.col("_pos") < long_rows, F.floor(F.col("_pos") / (size + 1))).otherwise(
        extra + F.floor((F.col("_pos") - long_rows) / F.nullif(size, F.lit(0)))
    )
    return numbered.withColumn(out, fold.cast("int")).drop("_pos", "_pos_total")


def running_total(df: DataFrame, order: Sequence[Column], size: str, out: str) -> DataFrame:
    """Sum of ``size`` over all rows before each row in a total order, without a single-task window."""
    cut = stage(df.orderBy(*order).withColumn("_part", F.spark_partition_id()), "sorted")
    sums = cut.groupBy("_part").agg(F.sum(size).alias("_sum"))
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select("_part", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_before"))
    within = Window.partitionBy("_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    local = cut.withColumn("_local", F.coalesce(F.sum(size).over(within), F.lit(0)))
    return lookup(local, offsets, ["_part"], "inner").withColumn(out, F.col("_before") + F.col("_local")).drop("_part", "_before", "_local")


# A key with more than one hundredth of a fold's share is heavy: fewer than a hundred keys for each fold.
HEAVY_KEYS = 100


def heavy_limit(total: int, k: int) -> int:
    """Keys with more rows than this are dealt to ``k`` folds one by one."""
    return total // (k * HEAVY_KEYS)


def group_folds(df: DataFrame, key: str, k: int, out: str = "fold") -> DataFrame:
    """Folds of about one size that keep all rows of a key together.

    Heavy keys, a bounded list, go to the emptiest fold each, largest first. The light ones lie on a line in the
    order of their hash, each as long as it has rows; what room the folds have left up to a common level cuts
    the line. A fold so ends within one light key of the level, or keeps the heavy keys that put it above.
    Null is a key like any other.
    """
    sizes = stage(df.groupBy(F.col(key).alias("_key")).agg(F.count("*").alias("_size")), "group-sizes")
    total = sizes.agg(F.sum("_size")).first()[0] or 0
    limit = heavy_limit(total, k)
    load, heavy = [0] * k, []
    for row in sizes.where(F.col("_size") > limit).orderBy(F.desc("_size"), "_key").collect() if limit else []:
        fold = load.index(min(load))
        load[fold] += row["_size"]
        heavy.append((row["_key"], fold))
    rest, level = total - sum(load), max(load, default=0)
    by_load = sorted(load)
    for i in range(1, k + 1):  # the level up to which the i emptiest folds together hold the rest
        level = (sum(by_load[:i]) + rest) / i
        if i == k or level <= by_load[i]:
            break
    bounds, at = [], 0.0
    for x in load[:-1]:
        at += max(0.0, level - x)
        bounds.append(at)
    light = running_total(sizes.where(F.col("_size") <= limit) if limit else sizes, [F.xxhash64("_key"), F.col("_key")], "_size", "_at")
    middle = F.col("_at") + F.col("_size") / 2.0
    cut = sum((F.when(middle >= b, 1).otherwise(0) for b in bounds), F.lit(0)).cast("int")
    kind = sizes.schema["_key"].dataType.simpleString()
    dealt = light.select("_key", cut.alias(out)).unionByName(df.sparkSession.createDataFrame(heavy, f"_key {kind}, {out} int"))
    return df.join(small_side(dealt), F.col(key).eqNullSafe(F.col("_key")), "left").drop("_key")
