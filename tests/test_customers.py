import datetime as dt

import pytest
from helpers import plan, rows
from pyspark.sql import functions as F

from offerwise.operators import campaigns, cubes, customers, lines, trajectories
from offerwise.plans.customer_table import customer_table

LINE = (
    "date date, customer_id bigint, item_id bigint, quantity double, selling_price double, "
    "other_discount double, coupon_discount double, order_id bigint, line_no int, store_id bigint"
)
ITEMS = [(1, "b1", "Established", "Meat"), (2, "b2", "Local", "Meat"), (3, "b1", "Established", "Travel")]
CATEGORIES = ("Meat", "Travel")


def day(n):
    return dt.date(2013, 1, 1) + dt.timedelta(n)


@pytest.fixture(scope="module")
def shop(spark):
    """Two overlapping campaigns; customer 9 only buys outside both; item 7 is not in the dimension."""
    buys = [
        # day, customer, item, quantity, price, other, coupon
        (0, 1, 1, 1.0, 10.0, -1.0, -2.0),
        (5, 1, 2, 2.0, 30.0, 0.0, -4.0),
        (5, 1, 3, 1.0, 8.0, -1.0, 0.0),
        (12, 1, 2, 4.0, 20.0, -2.0, -1.0),
        (3, 2, 7, 0.0, 5.0, 0.0, 0.0),
        (90, 9, 1, 1.0, 10.0, 0.0, -1.0),
    ]
    data = [(day(d), c, i, q, p, o, k, n, 1, 1) for n, (d, c, i, q, p, o, k) in enumerate(buys)]
    raw = spark.createDataFrame(data, LINE)
    item = spark.createDataFrame(ITEMS, "item_id bigint, brand string, brand_type string, category string")
    camp = spark.createDataFrame(
        [(4, "X", day(0), day(6)), (2, "Y", day(4), day(20))],
        "campaign_id int, campaign_type string, start_date date, end_date date",
    )
    codes = campaigns.prepare_campaigns(camp)
    described = lines.describe_lines(lines.add_items(raw, item), CATEGORIES)
    return described, codes, campaigns.campaign_window_join(described, codes)


def test_fan_out_and_dropped_lines(shop):
    _, _, w = shop
    got = rows(w.groupBy("customer_id", "camp_ord").count())
    assert got == [(1, 1, 3), (1, 2, 3), (2, 1, 1)]


def test_summary_counts_after_the_fan_out(shop):
    _, _, w = shop
    out = customers.customer_summary(w, cubes.item_cube(w)).orderBy("customer_id").collect()
    one, two = out
    assert (one.total_trans, one.total_coup_used, one.total_other_coup_used) == (6, 4, 4)
    assert (one.unique_item, one.unique_brand, one.unique_category) == (3, 2, 2)
    assert (one.unq_item_coup_used, one.unq_brand_coup_used, one.unq_categ_coup_used) == (2, 2, 1)
    assert one.cust_coupvsother_used_p == 1.0
    # Zero quantity, no discounts, unknown item: nothing to divide by and nothing to count.
    assert (two.total_trans, two.unique_item, two.unique_brand, two.sp_qty_mean) == (1, 1, 0, None)
    assert two.cust_coupvsother_used_p is None and two.qty_std is None


def test_pooled_summary_equals_the_one_from_lines(shop, retail):
    described, codes, w = shop
    for day, spend, rows_ in (
        (cubes.day_cube(described, codes), cubes.spend_cube(w), w),
        (cubes.day_cube(retail.lines, retail.campaign_codes), cubes.spend_cube(retail.windowed), retail.windowed),
    ):
        want = customers.spending_summary(rows_)
        got = customers.pooled_summary(spend, day).select(want.columns)
        for a, b in zip(want.orderBy("customer_id").collect(), got.orderBy("customer_id").collect()):
            for name, x, y in zip(want.columns, a, b):
                assert (y is None) if x is None else y == pytest.approx(x, rel=1e-9, abs=1e-9), name


def test_recency_of_lines_and_of_the_day_cube_agree(shop):
    described, codes, w = shop
    want = [(1, 184 - 13, 184 - 13), (2, None, 184 - 4)]
    assert rows(customers.recency(w)) == want
    assert rows(customers.recency(cubes.day_cube(described, codes))) == want
    assert rows(customers.recency(w, 2012)) == [(1, None, None), (2, None, None)]


def test_last_purchases_keep_fan_out_order(shop):
    _, _, w = shop
    out = customers.last_purchases(w, n=3, diffs=("Q",), levels=("SP",)).collect()
    assert [r.customer_id for r in out] == [1]
    # Newest first: day 12, then day 5 in campaign 1 and again in campaign 2.
    r = out[0]
    assert (r.QDiff_min, r.QDiff_max, r.QDiff_mean) == (-2.0, 0.0, -1.0)
    assert (r.SP_min, r.SP_max) == (5.0, 15.0)
    assert (r.I_uniq, r.B_uniq, r.C_uniq) == (1, 1, 1)


def test_last_days_are_distinct_and_newest_first(shop):
    described, codes, _ = shop
    assert rows(customers.last_days(cubes.day_cube(described, codes))) == [
        (1, -7, -5, -6.0, pytest.approx(2**0.5))
    ]


def test_modes_prefer_newer_then_smaller_item(shop):
    described, codes, w = shop
    item = customers.item_modes(cubes.item_cube(w)).orderBy("customer_id").collect()
    # b1: day 0 once, item 3 on day 5 twice = 3 rows; b2: day 5 twice, day 12 = 3 rows and newer.
    assert (item[0].MCbrand, item[0].MCitem_id, item[0].MCcategory) == ("b2", 2, 0)
    assert (item[0].MCbranddis, item[0].MCitem_iddis) == ("b2", 2)
    assert (item[1].MCbrand, item[1].MCitem_id, item[1].MCbranddis) == (None, 7, None)
    days = customers.day_modes(cubes.day_cube(described, codes)).orderBy("customer_id").collect()
    assert (days[0].MCYMon, days[0].MCt_dwk, days[0].MCt_dwkdis) == (201301, 6, 6)


def test_mode_per_group_breaks_ties_by_order(spark):
    df = spark.createDataFrame([(1, "a", 5), (1, "b", 2), (1, "a", 9), (1, "b", 8), (2, None, 1)], "k int, v string, o int")
    assert rows(customers.mode_per_group(df, ["k"], "v", [F.col("o")], "m")) == [(1, "b")]
    assert rows(customers.mode_per_group(df, ["k"], "v", [-F.col("o")], "m")) == [(1, "a")]


def test_coupon_twins_repeat_all_rows_unless_filtered(shop):
    described, codes, w = shop
    args = (described, w, codes)
    all_rows = trajectories.campaign_trajectory(*args, "sp_qty_mean_all")
    twin = trajectories.campaign_trajectory(*args, "sp_qty_mean_coupon")
    only = trajectories.campaign_trajectory(*args, "sp_qty_mean_coupon", quirks="clean")
    assert rows(all_rows) == rows(twin)
    assert rows(only.select("customer_id", "CT_sp_qty_mean_min", "CT_sp_qty_mean_max")) == [(1, 10.0, 12.5)]


def test_last_campaign_columns_exist_only_as_originally_defined(shop):
    described, codes, w = shop
    original = trajectories.campaign_trajectory(described, w, codes, "sp_qty_std_coupon")
    clean = trajectories.campaign_trajectory(described, w, codes, "sp_qty_std_coupon", quirks="clean")
    assert [c for c in original.columns if c.endswith("last_camp")] == ["CT_sp_qty_std_last_camp", "CT_sp_qty_stddiff_last_camp"]
    assert "CT_sp_qty_std_mean" not in original.columns and "CT_sp_qty_std_mean" in clean.columns


def test_whole_table_has_every_feature_once_per_customer(shop):
    described, codes, _ = shop
    table = customer_table(described, codes)
    assert len(table.columns) == len(set(table.columns)) == 258  # customer_id and 257 features
    assert sorted(r.customer_id for r in table.select("customer_id").collect()) == [1, 2]


def test_plans_stay_in_the_jvm_and_combine_before_the_shuffle(shop, retail):
    described, codes, w = shop
    item = cubes.item_cube(w)
    for df in (cubes.day_cube(described, codes), item, cubes.price_cube(w), cubes.spend_cube(w), customers.value_table(item)):
        text = plan(df)
        assert "Python" not in text and "NestedLoop" not in text
        assert text.count("HashAggregate") >= 2 and "SortAggregate" not in text
    scan = plan(cubes.price_cube(retail.windowed))
    assert "l_shipdate" not in scan and "o_totalprice" not in scan and "p_name" not in scan
