"""Offer (impression) features: campaign columns, breadth of a campaign, neighbouring offers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from offerwise.functions.scalars import day_ordinal, ratio
from offerwise.operators.campaigns import campaign_columns
from offerwise.operators.joins import attach, lookup
from offerwise.operators.ordering import HOT_ROWS, shifts
from offerwise.sources.staging import stage

UNKNOWN_LABEL = -9
REACH = (1, 2, 3, -1, -2, -3)


def union_train_test(train: DataFrame, test: DataFrame) -> DataFrame:
    """Labelled and unlabelled offers in one table; the test offers' label is the sentinel.

    A training offer without a label keeps its null: it takes part in the features of its neighbours,
    and the fit leaves it out.
    """
    kind = train.schema["redemption_status"].dataType
    unknown = test.withColumns({"train_set": F.lit(0), "redemption_status": F.lit(UNKNOWN_LABEL).cast(kind)})
    return train.withColumn("train_set", F.lit(1)).unionByName(unknown, allowMissingColumns=True)


def split(df: DataFrame, flag: str = "train_set") -> tuple[DataFrame, DataFrame]:
    return df.where(F.col(flag) == 1), df.where(F.col(flag) == 0)


def add_campaign(offers: DataFrame, campaign: DataFrame) -> DataFrame:
    """Campaign columns of every offer, with day-of-month parts and both ends as ordinals."""
    dim = campaign.select("campaign_id", "campaign_type", "start_date", "end_date")
    joined = campaign_columns(lookup(offers, dim, ["campaign_id"]), "month")
    return joined.withColumns(
        {
            "start_date_ord": day_ordinal(F.col("start_date")),
            "end_date_ord": day_ordinal(F.col("end_date")),
        }
    )


def coupon_reach(offers: DataFrame) -> DataFrame:
    """Distinct customers and offers per campaign and coupon: campaigns times coupons rows at most."""
    return offers.groupBy("campaign_id", "coupon_id").agg(
        F.count_distinct("customer_id").alias("camp_coup_unique_cust"), F.count("id").alias("_n")
    )


def customer_reach(offers: DataFrame) -> DataFrame:
    """Distinct coupons per campaign and customer."""
    return offers.groupBy("campaign_id", "customer_id").agg(
        F.count_distinct("coupon_id").alias("camp_cus_unique_coup")
    )


def campaign_totals(per_coupon: DataFrame, per_customer: DataFrame) -> DataFrame:
    """Per campaign: distinct coupons, distinct customers, offers.

    Counted from the two reach tables, so that a campaign, of which there are few, never has to
    hold its customers in one task.
    """
    coupons = per_coupon.groupBy("campaign_id").agg(
        F.count("coupon_id").alias("camp_coupon_idnunique"), F.sum("_n").alias("camp_id_count")
    )
    customers = per_customer.groupBy("campaign_id").agg(
        F.count("customer_id").alias("camp_customer_idnunique")
    )
    return coupons.join(customers, "campaign_id")


def campaign_breadth(offers: DataFrame) -> DataFrame:
    """Breadth counts of each offer's campaign and their shares of the campaign's offers.

    Both reach tables are staged: each serves twice, and the sizes of the small ones are then known
    before the offers are joined, so only the customer table moves the offers.
    """
    per_coupon = stage(coupon_reach(offers), "coupon-reach")
    per_customer = stage(customer_reach(offers), "customer-reach")
    totals = stage(campaign_totals(per_coupon, per_customer), "campaign-totals")
    joined = attach(offers, per_customer, ["campaign_id", "customer_id"])
    joined = lookup(joined, per_coupon.drop("_n"), ["campaign_id", "coupon_id"])
    joined = lookup(joined, totals, ["campaign_id"])
    shares = {
        "camp_coup_uniq_p": "camp_coupon_idnunique",
        "camp_cus_uniq_p": "camp_customer_idnunique",
        "camp_coup_cus_uniq_p": "camp_coup_unique_cust",
        "camp_cus_coup_uniq_p": "camp_cus_unique_coup",
    }
    total = F.col("camp_id_count")
    return joined.withColumns({out: ratio(F.col(c).cast("double"), total) for out, c in shares.items()})


def _shift_names(prefix: str) -> dict[int, str]:
    return {k: f"{prefix}_shift{'' if k > 0 else 'n'}{abs(k)}" for k in REACH}


# Four sequences of a customer's offers. Equal sort keys keep the order of the sequence before,
# which starts as training rows before test rows, each by id.
SEQUENCES = {
    "cus_str": ("start_date_ord", ("start_date_ord",)),
    "cus_camp": ("campaign_id", ("campaign_id", "start_date_ord")),
    "cus_coup": ("coupon_id", ("coupon_id", "start_date_ord", "campaign_id")),
    "cus_end": ("end_date_ord", ("start_date_ord", "coupon_id", "campaign_id")),
}


def neighbour_offers(offers: DataFrame, which: tuple[str, ...] = tuple(SEQUENCES), hot_rows: int = HOT_ROWS) -> DataFrame:
    """Three previous and three next starts, campaigns, coupons and ends of the same customer."""
    specs = []
    for prefix in which:
        value, order = SEQUENCES[prefix]
        columns = [*[F.asc(c) for c in order], F.desc("train_set"), F.asc("id")]
        specs.append((columns, {name: (value, k) for k, name in _shift_names(prefix).items()}))
    return shifts(offers, "customer_id", specs, hot_rows)


def start_gaps(df: DataFrame) -> DataFrame:
    """Days from each neighbouring start to this offer's start."""
    names = _shift_names("cus_str")
    return df.withColumns(
        {f"diff{'' if k > 0 else 'n'}{abs(k)}_cus_str": F.col("start_date_ord") - F.col(names[k]) for k in REACH}
    )


def end_start_gaps(df: DataFrame) -> DataFrame:
    """Days between the end of one neighbour and the start of the next nearer one."""
    starts, ends = _shift_names("cus_str"), _shift_names("cus_end")
    out = {}
    for k in REACH:
        nearer = k - 1 if k > 0 else k + 1
        base = F.col(starts[nearer]) if nearer else F.col("start_date_ord")
        out[f"diff{'' if k > 0 else 'n'}{abs(k)}_cus_end"] = F.col(ends[k]) - base
    return df.withColumns(out)


def offer_table(offers: DataFrame, campaign: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """All offer features, one row per offer."""
    broad = campaign_breadth(add_campaign(offers, campaign))
    return end_start_gaps(start_gaps(neighbour_offers(broad, hot_rows=hot_rows)))

