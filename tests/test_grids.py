"""Grids against a dense computation in pandas, and hand-worked cases."""

import math
import random

import numpy as np
import pandas as pd
import pytest
from helpers import rows
from pyspark.sql import functions as F

from offerwise.functions.stats import clean, cumulative, moments
from offerwise.operators import grids


def row_stats(spark, cells, form):
    df = spark.createDataFrame([(1, float(x)) for x in cells] or [(1, None)], "k int, v double")
    sums = df.groupBy("k").agg(*moments(F.col("v"), "x"))
    return sums.select(*[c.alias(s) for s, c in form("x").items()]).first()


def test_cumulative_statistics(spark):
    assert tuple(row_stats(spark, [2, 4, 9], cumulative)) == pytest.approx((2, 9, 5.2, 3.18747549))
    assert tuple(row_stats(spark, [5], cumulative)) == (5, 5, 5, 0)
    assert tuple(row_stats(spark, [], cumulative)) == (None,) * 4


def test_clean_statistics(spark):
    assert tuple(row_stats(spark, [2, 4, 9], clean)) == pytest.approx((2, 9, 5, 3.60555128))
    assert tuple(row_stats(spark, [5], clean)) == (5, 5, 5, None)


def cumulative_of(values):
    v = [x for x in values if not math.isnan(x)]
    if not v:
        return [None] * 4
    v += [min(v), max(v)]
    v.append(sum(v) / len(v))
    return [min(v), max(v), v[-1], float(np.std(v, ddof=1))]


def dense(cells, kind):
    """Wide grid of one measure with the rules of its kind."""
    wide = pd.DataFrame(cells, columns=["c", "slot", "v"]).pivot(index="c", columns="slot", values="v")
    wide = wide[sorted(wide.columns)]
    if kind == grids.COUNT:
        return wide.fillna(0.0)
    if kind == grids.SHARE:
        users = wide.max(axis=1) > 0
        wide.loc[:, wide.max(axis=0) <= 0] = np.nan
        wide = wide[users]
    return wide


def random_cells(kind, rng):
    """A random grid with empty cells, up to 7 customers by 8 slots."""
    density = rng.choice((0.2, 0.5, 0.9))
    low = 1 if kind == grids.COUNT else 0  # a count cell exists only where there is a row
    return [
        (c, s, float(rng.randint(low, 4) if rng.random() < 0.6 else low))
        for c in range(1, rng.randint(2, 8))
        for s in range(1, rng.randint(2, 9))
        if rng.random() < density
    ]


def test_sparse_grids_equal_dense_ones(spark):
    rng = random.Random(11)
    tables = {f"m{i}": (kind, random_cells(kind, rng)) for i, kind in enumerate([grids.COUNT, grids.SHARE, grids.VALUE] * 20)}
    kinds = {m: kind for m, (kind, _) in tables.items()}
    df = spark.createDataFrame(
        [(c, m, s, v) for m, (_, cells) in tables.items() for c, s, v in cells],
        "customer_id int, measure string, slot bigint, v double",
    )
    got = {(r.customer_id, r.measure): r for r in grids.trajectory_stats(df, kinds).collect()}
    checked = 0
    for m, (kind, cells) in tables.items():
        if not cells:
            continue
        wide = dense(cells, kind)
        assert {c for c, mm in got if mm == m} == set(wide.index)
        for customer, values in wide.iterrows():
            for part, series in (("level", values), ("diff", values.diff().iloc[1:])):
                if part == "level" and kind == grids.COUNT:
                    continue  # levels of counts are not summarised
                have = [got[customer, m][f"{part}_{s}"] for s in ("min", "max", "mean", "std")]
                assert have == pytest.approx(cumulative_of(series.tolist()), abs=1e-9), (m, customer, part)
                checked += 1
    assert checked > 200


def test_an_all_null_column_leaves_the_list(spark):
    # Slot 2 has no value for anybody, so slots 1 and 3 are neighbours.
    df = spark.createDataFrame([(1, "x", 1, 2.0), (1, "x", 3, 7.0)], "customer_id int, measure string, slot bigint, v double")
    out = grids.widen(grids.trajectory_stats(df, {"x": grids.VALUE}), [grids.Family("d", "x", "diff")])
    assert rows(out) == [(1, 5.0, 5.0, 5.0, 0.0)]


def test_tail_columns_of_the_last_slot(spark):
    data = [(1, "x", s, v) for s, v in ((1, 1.0), (2, 4.0), (3, 9.0), (4, 20.0))] + [(2, "x", 1, 5.0), (2, "x", 2, 6.0)]
    df = spark.createDataFrame(data, "customer_id int, measure string, slot bigint, v double")
    out = grids.trajectory_stats(df, {"x": grids.VALUE}).select(
        "customer_id", "tail_min", "tail_max", "tail_value", "tail_step"
    )
    assert rows(out) == [(1, 3.0, 5.0, 20.0, 5.0), (2, 1.0, 1.0, None, None)]


def test_share_cells_by_hand(spark):
    # Customer 1: coupon rows in campaign 1 only; customer 3 never uses coupons; nobody uses one in campaign 2.
    n = {(1, 1): (2, 1), (1, 2): (1, 0), (3, 1): (2, 0), (3, 2): (1, 0)}
    cells = spark.createDataFrame(
        [(c, "s", k, u / t) for (c, k), (t, u) in n.items()], "customer_id int, measure string, slot bigint, v double"
    )
    out = grids.widen(
        grids.trajectory_stats(cells, {"s": grids.SHARE}), [grids.Family("s", "s"), grids.Family("d", "s", "diff")]
    )
    assert rows(out) == [(1, 0.5, 0.5, 0.5, 0.0, None, None, None, None)]


def test_ratio_of_grids_counts_absent_numerators_as_zero(spark):
    den = spark.createDataFrame([(1, 1, 4.0), (1, 2, 2.0), (2, 1, 0.0)], "customer_id int, camp_ord int, v double")
    num = spark.createDataFrame([(1, 1, 1.0)], "customer_id int, camp_ord int, v double")
    assert rows(grids.grid_ratio(num, den, ["customer_id", "camp_ord"], "x")) == [(1, 1, 0.25), (1, 2, 0.0), (2, 1, None)]


@pytest.mark.parametrize("form", ["cumulative", "clean"])
def test_equal_steps_of_large_counts_have_no_deviation(spark, form):
    """Cells that grow by one large step: squares of the counts would not fit a double."""
    data = [(c, "m", slot, float((10**8 + c) * (slot + 1))) for c in range(40) for slot in range(7)]
    cells = spark.createDataFrame(data, "customer_id int, measure string, slot bigint, v double")
    stats = grids.trajectory_stats(cells, {"m": grids.COUNT}, form).collect()
    assert len(stats) == 40 and all(r.diff_std == 0 and r.diff_mean == 10**8 + r.customer_id for r in stats)


def test_large_counts_with_gaps_equal_a_direct_computation(spark):
    rng = random.Random(8)
    data = [(c, "m", slot, float(rng.randint(10**9, 2 * 10**9))) for c in range(30) for slot in range(12) if rng.random() < 0.6]
    data += [(99, "m", slot, 1.0) for slot in range(12)]
    cells = spark.createDataFrame(data, "customer_id int, measure string, slot bigint, v double")
    got = {r.customer_id: r.diff_std for r in grids.trajectory_stats(cells, {"m": grids.COUNT}, "clean").collect()}
    for c in range(30):
        row = [next((v for i, _, s, v in data if i == c and s == slot), 0.0) for slot in range(12)]
        assert any(row) is False or got[c] == pytest.approx(float(np.std(np.diff(row), ddof=1)), rel=1e-9)
