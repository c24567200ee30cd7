"""What the customer table stages and leaves behind."""

import os

from helpers import rows

from offerwise.plans import customer_table as ct
from offerwise.sources import staging
from offerwise.sources.retail import CATEGORIES, REF_YEAR


def test_customer_table_drops_lines_and_items_and_stages_no_prices(retail, monkeypatch):
    staged, stage = {}, staging.stage

    def watched(df, label):
        out = stage(df, label)
        staged[label] = (out.staged_path.removeprefix("file://"), out.columns)
        return out

    monkeypatch.setattr(staging, "stage", watched)
    monkeypatch.setattr(ct, "stage", watched)
    table = ct.customer_table(retail.lines, retail.campaign_codes, CATEGORIES, REF_YEAR)
    assert not set(ct.PRICES) & set(staged["lines"][1])
    assert [x for x, (path, _) in staged.items() if not os.path.exists(path)] == ["lines", "item-cube"]
    # Lines that carry the prices alone give the same table.
    priced = ct.customer_table(retail.lines.drop("other_discount", "coupon_discount"), retail.campaign_codes, CATEGORIES, REF_YEAR)
    assert rows(table) == rows(priced)


def test_shuffle_files_go_with_their_query(spark, retail):
    ct.customer_table(retail.lines, retail.campaign_codes, CATEGORIES, REF_YEAR)
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "true"
