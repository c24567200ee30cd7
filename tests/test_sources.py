import datetime as dt

import pytest
from helpers import rows

from offerwise.operators import profile
from offerwise.sources import staging, tables


def write(path, name, text):
    target = path / name
    target.write_text(text)
    return str(target)


def test_csv_tables_follow_their_schema(spark, tmp_path):
    path = write(tmp_path, "c.csv", "campaign_id,campaign_type,start_date,end_date\n24,Y,21/10/13,20/12/13\n")
    assert rows(tables.read_campaigns(spark, path)) == [(24, "Y", dt.date(2013, 10, 21), dt.date(2013, 12, 20))]
    path = write(tmp_path, "t.csv", "date,customer_id,item_id,quantity,selling_price,other_discount,coupon_discount\n2012-01-02,1501,26830,1,35.26,-10.69,0.0\n")
    row = tables.read_table(spark, path, "customer_transaction_data").first()
    assert tuple(row) == (dt.date(2012, 1, 2), 1501, 26830, 1.0, 35.26, -10.69, 0.0)


def test_malformed_rows_fail(spark, tmp_path):
    path = write(tmp_path, "m.csv", "coupon_id,item_id\n1,x\n")
    with pytest.raises(Exception):
        tables.read_table(spark, path, "coupon_item_mapping").collect()


def test_scores_and_importance_come_back(spark, tmp_path):
    scores = spark.createDataFrame([(1, 0.25, "x"), (2, 0.5, "y")], "id bigint, redemption_status double, extra string")
    tables.write_scores(scores, str(tmp_path / "s"))
    assert rows(tables.read_table(spark, str(tmp_path / "s"), "submission")) == [(1, 0.25), (2, 0.5)]
    ranks = spark.createDataFrame([("a", 1, 10.0), ("b", 5, 90.0)], "feature string, split bigint, gain double")
    tables.write_importance(ranks, str(tmp_path / "i"))
    assert [r.feature for r in tables.read_table(spark, str(tmp_path / "i"), "importance").collect()] == ["b", "a"]


def test_staged_tables_lie_in_the_shared_folder_and_prune(spark):
    df = spark.range(10).selectExpr("id", "id * 2 as twice")
    staged = staging.stage(df, "demo")
    assert staged.count() == 10
    assert staged.inputFiles()[0].removeprefix("file://").startswith(staging.shared_folder(spark))
    text = staged.select("id")._jdf.queryExecution().executedPlan().toString()
    assert "twice" not in text


def test_the_cluster_setting_wins():
    class Conf:
        def __init__(self, **values):
            self.values = values

        def get(self, key, default=None):
            return self.values.get(key, default)

    class Session:
        def __init__(self, **values):
            self.conf = Conf(**values)

    named = Session(**{"spark.checkpoint.dir": "hdfs://shared/tmp/", "spark.master": "yarn"})
    assert staging.shared_folder(named) == "hdfs://shared/tmp"
    with pytest.raises(ValueError):
        staging.shared_folder(Session(**{"spark.master": "yarn"}))


def test_a_line_moves_once_on_its_way_to_its_order(spark):
    from helpers import plan

    from offerwise.sources.retail import RetailTables

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(RetailTables(spark, "/root/testdata/sf0.001").transactions)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert text.count("Exchange hashpartitioning(l_orderkey") == 1 and text.count("Exchange ") == 2


def test_a_run_releases_what_it_staged(spark):
    df = staging.stage(spark.range(5).toDF("x"), "demo")
    path = df.inputFiles()[0].rsplit("/", 1)[0]
    assert path.removeprefix("file://").startswith(staging.run_folder(spark).removeprefix("file://"))
    assert spark.read.parquet(path).count() == 5
    staging.release(spark)
    with pytest.raises(Exception):
        spark.read.parquet(path).count()
    assert staging.stage(spark.range(3).toDF("x"), "demo").count() == 3


def test_broadcast_bound_follows_the_width(spark):
    from offerwise.operators import joins

    narrow = spark.range(1)
    wide = narrow.selectExpr("id", *[f"'x' as t{i}" for i in range(60)])
    assert joins.broadcast_rows(wide) * joins.row_bytes(wide) <= joins.BROADCAST_BYTES
    assert joins.broadcast_rows(narrow) > 50 * joins.broadcast_rows(wide)


def test_profiles(spark):
    df = spark.createDataFrame([("a", 1), ("b", None), ("a", None)], "x string, y int")
    assert rows(profile.null_counts(df)) == [("x", 0), ("y", 2)]
    assert [tuple(r) for r in profile.value_counts(df, "x").collect()] == [("a", 2), ("b", 1)]
    assert rows(profile.value_counts_all(df)) == [("x", "a", 2), ("x", "b", 1), ("y", "1", 1)]
    assert rows(profile.schema_table(df)) == [(0, "x", "string"), (1, "y", "int")]
    assert tuple(profile.shape(df).first()) == (3, 2)
    assert [r.y for r in profile.top_k(df, "y", 1).collect()] == [1]


def test_swapped_headers_fail(spark, tmp_path):
    path = write(tmp_path, "h.csv", "item_id,coupon_id\n777,1\n")
    with pytest.raises(Exception, match="(?i)header|column"):
        tables.read_table(spark, path, "coupon_item_mapping").collect()
