import datetime as dt

import pytest
from helpers import plan, rows
from pyspark.sql import functions as F

from offerwise.operators import coupons, offers
from offerwise.plans.training_table import EXCLUDED, feature_columns

CATS = ("Grocery", "Meat")


@pytest.fixture(scope="module")
def mapping(spark):
    ci = spark.createDataFrame([(1, 1), (1, 2), (1, 3), (1, 4), (2, 99)], "coupon_id bigint, item_id bigint")
    item = spark.createDataFrame(
        [(1, 7, "Established", "Grocery"), (2, 7, "Established", "Grocery"), (3, 8, "Local", "Grocery"), (4, 8, "Established", "Meat")],
        "item_id bigint, brand bigint, brand_type string, category string",
    )
    return ci, item


def test_breadth_counts_pairs_not_items(mapping):
    table = coupons.coupon_breadth(coupons.coupon_cube(coupons.add_items(*mapping)), CATS)
    assert rows(table) == [(1, 2, 1, 1, 1), (2, 0, 0, 0, 0)]


def test_coupon_table_of_unknown_items(mapping):
    out = {r.coupon_id: r for r in coupons.coupon_table(*mapping, CATS).collect()}
    assert (out[1].coup_brand_uniq, out[1].coup_brand_cnt, out[1].coup_brand_uniq_p) == (2, 4, 0.5)
    assert (out[1].MCCoupbrand, out[1].MCCoupcategory_c, out[1].MCCoupcategory_Grocery, out[1].Grocery_cnt) == (7, "Grocery", 1, 3)
    assert (out[2].coup_brand_cnt, out[2].coup_brand_uniq_p, out[2].MCCoupbrand, out[2].Meat_cnt) == (0, None, None, 0)


@pytest.fixture(scope="module")
def offered(spark):
    camp = spark.createDataFrame(
        [(1, "X", dt.date(2013, 1, 1), dt.date(2013, 2, 1)), (2, "Y", dt.date(2013, 1, 1), dt.date(2013, 3, 1)), (3, "X", dt.date(2013, 2, 10), dt.date(2013, 3, 20))],
        "campaign_id int, campaign_type string, start_date date, end_date date",
    )
    train = spark.createDataFrame([(10, 2, 5, 1, 0), (11, 1, 6, 1, 1), (12, 1, 5, 2, 0)], "id bigint, campaign_id int, coupon_id bigint, customer_id bigint, redemption_status int")
    test = spark.createDataFrame([(1, 3, 5, 1)], "id bigint, campaign_id int, coupon_id bigint, customer_id bigint")
    return offers.union_train_test(train, test), camp


def test_union_marks_missing_labels(offered):
    both, _ = offered
    assert rows(both.select("id", "train_set", "redemption_status")) == [(1, 0, -9), (10, 1, 0), (11, 1, 1), (12, 1, 0)]
    train, test = offers.split(both)
    assert (train.count(), test.count()) == (3, 1)


def test_four_sequences_and_their_ties(offered):
    both, camp = offered
    table = offers.neighbour_offers(offers.add_campaign(both, camp))
    first = table.where("customer_id = 1")
    # Equal starts keep training order (10 before 11); by campaign 11 comes first; by coupon 10, 1, 11.
    assert rows(first.select("id", "cus_str_shift1", "cus_str_shiftn1")) == [(1, 734869, None), (10, None, 734869), (11, 734869, 734909)]
    assert rows(first.select("id", "cus_camp_shift1")) == [(1, 2), (10, 1), (11, None)]
    assert rows(first.select("id", "cus_coup_shift1")) == [(1, 5), (10, None), (11, 5)]
    # Ends follow start, then coupon: 10 (coupon 5) before 11 (coupon 6).
    gaps = offers.end_start_gaps(offers.start_gaps(table)).where("customer_id = 1")
    assert rows(gaps.select("id", "diff1_cus_str", "diffn1_cus_str")) == [(1, 40, None), (10, None, 0), (11, 0, -40)]
    assert rows(gaps.select("id", "diff1_cus_end", "diff2_cus_end")) == [(1, 31 - 40, 59), (10, None, None), (11, 59, None)]


def test_breadth_of_a_campaign(offered):
    both, _ = offered
    out = {r.id: r for r in offers.campaign_breadth(both).collect()}
    assert (out[11].camp_coupon_idnunique, out[11].camp_customer_idnunique, out[11].camp_id_count) == (2, 2, 2)
    assert (out[11].camp_coup_unique_cust, out[11].camp_cus_unique_coup, out[11].camp_cus_uniq_p) == (1, 1, 1.0)


def test_model_columns(offered):
    both, camp = offered
    table = offers.offer_table(both, camp)
    kept = feature_columns(table)
    assert {"campaign_id", "coupon_id", "customer_id", "diff_camp_days", "diffn3_cus_end"} <= set(kept)
    assert not set(kept) & set(EXCLUDED)


def test_campaign_lookup_is_broadcast(offered):
    both, camp = offered
    assert "BroadcastHashJoin [campaign_id" in plan(offers.add_campaign(both, camp))
    assert offers.add_campaign(both, camp).where(F.col("s_d") == 10).count() == 1


def test_only_test_offers_get_the_unknown_label(spark):
    train = spark.createDataFrame([(1, 1), (2, None)], "id bigint, redemption_status int")
    test = spark.createDataFrame([(3,)], "id bigint")
    got = {(r.id, r.train_set, r.redemption_status) for r in offers.union_train_test(train, test).collect()}
    assert got == {(1, 1, 1), (2, 1, None), (3, 0, -9)}


def test_coupon_mapping_grows_with_the_items(spark):
    from offerwise.sources.retail import RetailTables

    sizes = {}
    for sf in ("0.001", "0.01", "0.1"):
        data = RetailTables(spark, f"/root/testdata/sf{sf}")
        sizes[sf] = data.coupon_item.count() / data.item.count()
    assert max(sizes.values()) < 2 and max(sizes.values()) < 1.5 * min(sizes.values())


def test_the_wide_join_of_offers_has_an_exchange_of_its_own(spark):
    from offerwise.plans.training_table import assemble
    from offerwise.session import apply_settings
    from offerwise.sources.retail import RetailTables
    from offerwise.sources.staging import stage

    apply_settings(spark)
    data = RetailTables(spark, "/root/testdata/sf0.001")
    table = stage(offers.offer_table(data.offers, data.campaign), "offer-table")
    customers = table.groupBy("customer_id").count()
    few = spark.createDataFrame([(1, 2)], "coupon_id bigint, x int")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(assemble(table, few, customers))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    join = text[text.index("SortMergeJoin") :]
    assert "Window" not in join and join.count("Exchange hashpartitioning(customer_id") >= 2
    assert spark.conf.get("spark.sql.adaptive.forceOptimizeSkewedJoin") == "true"
