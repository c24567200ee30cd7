"""Registered queries against their SQL. All of them with CHECK_ALL=1, a cross-section otherwise."""

import os

import pytest

from checks.compare import compare, database
from checks.queries import REGISTRY

FOLDER = "/root/testdata/sf0.001"
SAMPLE = (
    "csv_scan__S1", "null_counts__PR1", "unit_prices__P7", "period_keys__P4", "cell_diff__P21", "attach_aggregate__J3_J6",
    "customer_summary__A1", "usual_items__A7a", "count_grid__A8", "trip_change_wk__V4", "coupon_share__V2",
    "coupon_share_change_dwk__V9", "sp_qty_std_coupon__V15", "sp_qty_std_coupon_filtered__V15", "coupon_rate_by_category__V24",
    "last_days__L1", "last_sp_qty__L6", "cus_coup_shifts__W2c", "campaign_breadth__W7", "contiguous_folds__W6_M2",
    "coupon_table__C4", "offer_table__E2", "customer_table__E1", "fold_auc__M5", "campaign_window_join_shuffled__J5",
    "group_folds__M10", "feature_matrix__M1", "train_fold__M3",
)


@pytest.fixture(scope="module")
def con():
    return database(FOLDER)


@pytest.mark.parametrize("name", list(REGISTRY) if os.environ.get("CHECK_ALL") else SAMPLE)
def test_query_equals_its_sql(spark, con, name):
    good, note = compare(spark, con, FOLDER, name)
    assert good is not False, note


def test_entry_points(spark):
    import __spark_entry__ as e

    assert set(e.oracle_sql()) <= set(e.queries())
    assert e.entry(spark).count() == 150
