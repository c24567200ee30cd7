"""A promotion data set derived from an order-and-line star schema.

The order tables carry no promotions, so campaigns, items, purchase lines, coupons and offers are
derived from them by fixed rules. Everything is a lazy DataFrame over the Parquet files.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from offerwise.operators.campaigns import campaign_order, campaign_window_join, prepare_campaigns
from offerwise.operators.joins import lookup
from offerwise.operators.lines import add_items, describe_lines

# The part types of the star schema; the position is the code.
CATEGORIES = ("ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD")
# Columns of the star schema's tables, in file order.
SCHEMAS = {
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
        "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
        "l_shipdate timestamp_ntz"
    ),
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
        "o_orderdate timestamp_ntz, o_orderpriority string"
    ),
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
}
CAMPAIGNS = 28
TRAIN_CAMPAIGNS = 18
REF_YEAR = 2001


@dataclass(frozen=True)
class RetailTables:
    spark: SparkSession
    folder: str

    def table(self, name: str) -> DataFrame:
        return self.spark.read.schema(SCHEMAS[name]).parquet(f"{self.folder}/{name}.parquet")

    @cached_property
    def campaign(self) -> DataFrame:
        """28 windows of 60 to 180 days, one every 85 days; ids 14 and 15 do not exist."""
        k = F.col("k").cast("int")
        opening = F.lit("1995-01-01").cast("date")
        start = (k - 1) * 85
        return self.spark.range(1, CAMPAIGNS + 1).toDF("k").select(
            F.when(k <= 13, k).otherwise(k + 2).alias("campaign_id"),
            F.when(k % 2 == 0, "X").otherwise("Y").alias("campaign_type"),
            F.date_add(opening, start).alias("start_date"),
            F.date_add(opening, start + 60 + (k % 4) * 40).alias("end_date"),
        )

    @cached_property
    def campaign_codes(self) -> DataFrame:
        return prepare_campaigns(self.campaign)

    @cached_property
    def item(self) -> DataFrame:
        local = F.col("p_size") % 4 == 0
        return self.table("part").select(
            F.col("p_partkey").alias("item_id"),
            F.col("p_brand").alias("brand"),
            F.when(local, "Local").otherwise("Established").alias("brand_type"),
            F.col("p_type").alias("category"),
        )

    @cached_property
    def transactions(self) -> DataFrame:
        c = F.col
        with_coupon = (c("l_returnflag") == "R") & (c("l_linestatus") == "F")
        # The exchange the join with the orders needs anyway; files with few splits fan out here.
        lines = self.table("lineitem").repartition("l_orderkey")
        orders = self.table("orders")
        return lines.join(orders, c("l_orderkey") == c("o_orderkey")).select(
            c("o_orderdate").cast("date").alias("date"),
            c("o_custkey").alias("customer_id"),
            c("l_partkey").alias("item_id"),
            c("l_quantity").alias("quantity"),
            c("l_extendedprice").alias("selling_price"),
            (-(c("l_extendedprice") * c("l_tax")) + F.lit(0.0)).alias("other_discount"),
            F.when(with_coupon, -(c("l_extendedprice") * c("l_discount")) + F.lit(0.0))
            .otherwise(0.0)
            .alias("coupon_discount"),
            c("l_orderkey").alias("order_id"),
            c("l_linenumber").alias("line_no"),
            c("l_suppkey").alias("store_id"),
        )

    @cached_property
    def lines(self) -> DataFrame:
        """Purchase lines with item attributes and all derived columns."""
        return describe_lines(add_items(self.transactions, self.item), CATEGORIES)

    @cached_property
    def windowed(self) -> DataFrame:
        """Lines repeated for every campaign window that holds their date."""
        return campaign_window_join(self.lines, self.campaign_codes)

    @cached_property
    def coupon_item(self) -> DataFrame:
        """Each item is in two of a hundred coupons at most, so the mapping grows with the items."""
        c = F.col
        key = c("p_partkey")
        both = F.array_distinct(F.array(key % 100, (key * 7 + 3) % 100))
        parts = self.table("part").select(key.alias("item_id"), "p_size", F.explode(both).alias("coupon_id"))
        return parts.where(c("p_size") <= 5 + (c("coupon_id") % 10) * 5).select("coupon_id", "item_id")

    @cached_property
    def offers(self) -> DataFrame:
        """One offer per order; the first 18 campaigns are labelled, the others carry -9."""
        c = F.col
        order = 1 + (c("o_orderkey") * 7 + c("o_custkey")) % CAMPAIGNS
        dim = campaign_order(self.campaign).select("campaign_id", "camp_ord")
        orders = self.table("orders").withColumn("camp_ord", order.cast("int"))
        redeemed = (c("o_orderpriority") == "1-URGENT") & (c("o_orderstatus") == "F")
        labelled = c("camp_ord") <= TRAIN_CAMPAIGNS
        return lookup(orders, dim, ["camp_ord"], "inner").select(
            c("o_orderkey").alias("id"),
            "campaign_id",
            (c("o_orderkey") % 100).alias("coupon_id"),
            c("o_custkey").alias("customer_id"),
            F.when(labelled, 1).otherwise(0).alias("train_set"),
            F.when(~labelled, -9).when(redeemed, 1).otherwise(0).alias("redemption_status"),
        )
