import datetime as dt

from helpers import plan, rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from offerwise.operators import campaigns

OPENING = dt.date(2012, 8, 1)
SCHEMA = "campaign_id int, campaign_type string, start_date date, end_date date"


def frames(spark, spans, days):
    camp = [(i + 1, "X", OPENING + dt.timedelta(a), OPENING + dt.timedelta(a + b)) for i, (a, b) in enumerate(spans)]
    lines = [(i, OPENING + dt.timedelta(d)) for i, d in enumerate(days)]
    return spark.createDataFrame(camp, SCHEMA), spark.createDataFrame(lines, "line int, date date"), camp, lines


@given(
    st.lists(st.tuples(st.integers(0, 20), st.integers(0, 12)), min_size=1, max_size=5),
    st.lists(st.integers(-2, 35), min_size=1, max_size=25),
)
@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
def test_window_join_is_the_union_of_filters(spark, spans, days):
    camp_df, line_df, camp, lines = frames(spark, spans, days)
    joined = campaigns.campaign_window_join(line_df, campaigns.campaign_order(camp_df), ("camp_ord",))
    order = sorted(range(len(camp)), key=lambda i: (camp[i][2], camp[i][0]))
    want = sorted((n, k + 1) for k, i in enumerate(order) for n, d in lines if camp[i][2] <= d <= camp[i][3])
    assert sorted((r.line, r.camp_ord) for r in joined.collect()) == want
    literals = [(k + 1, str(camp[i][2]), str(camp[i][3])) for k, i in enumerate(order)]
    union = campaigns.union_of_windows(line_df, literals)
    assert sorted((r.line, r.camp_ord) for r in union.collect()) == want


def test_campaigns_starting_together_rank_by_id(spark):
    day = dt.date(2013, 4, 22)
    camp = spark.createDataFrame([(12, "X", day, day), (11, "Y", day, day), (3, "X", dt.date(2012, 1, 1), day)], SCHEMA)
    out = campaigns.prepare_campaigns(camp).select("campaign_id", "camp_ord", "campaign_type")
    assert rows(out) == [(3, 1, 0), (11, 2, 1), (12, 3, 0)]


def test_join_beyond_the_broadcast_bound_gives_the_same(spark, retail):
    small = campaigns.campaign_window_join(retail.transactions, retail.campaign_codes)
    large = campaigns.campaign_window_join(retail.transactions, retail.campaign_codes, max_rows=0)
    cols = ["customer_id", "item_id", "order_id", "line_no", "camp_ord"]
    assert rows(small.select(cols)) == rows(large.select(cols))


def test_plan_hashes_on_the_day(spark, retail):
    text = plan(campaigns.campaign_window_join(retail.transactions, retail.campaign_codes))
    assert "BroadcastHashJoin [date" in text
    assert "NestedLoop" not in text and "Cartesian" not in text


def test_fan_out_counts_add_up(spark, retail):
    per_campaign = retail.windowed.groupBy("camp_ord").count().agg(F.sum("count")).first()[0]
    assert per_campaign == retail.windowed.count() == 8447
