"""Campaign calendar and the interval join of purchase lines to campaigns."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from offerwise.functions.codes import CAMPAIGN_TYPES
from offerwise.functions.scalars import date_parts, encode, span_days, year_day, year_month
from offerwise.operators.joins import broadcast_rows

# Into how many shares a day's lines are dealt where the calendar is too large to broadcast.
SHARES = 32


def campaign_order(campaign: DataFrame) -> DataFrame:
    """Add ``camp_ord``, the rank by start date; campaigns starting together rank by id.

    The unpartitioned window is over the campaign dimension, never over facts.
    """
    by_start = Window.orderBy("start_date", "campaign_id")
    return campaign.withColumn("camp_ord", F.row_number().over(by_start))


def prepare_campaigns(campaign: DataFrame) -> DataFrame:
    """Campaign dimension with its order and the code of its type."""
    return campaign_order(campaign).withColumn(
        "campaign_type", encode(F.col("campaign_type"), CAMPAIGN_TYPES)
    )


def calendar(campaign: DataFrame) -> DataFrame:
    """One row per campaign and day of its window, both ends included."""
    days = F.sequence("start_date", "end_date", F.expr("interval 1 day"))
    return campaign.where(F.col("start_date") <= F.col("end_date")).withColumn("date", F.explode(days))


def campaign_window_join(
    lines: DataFrame,
    campaign: DataFrame,
    columns: Sequence[str] = ("campaign_id", "camp_ord", "campaign_type"),
    max_rows: int | None = None,
) -> DataFrame:
    """Repeat each line for every campaign whose window holds its date; other lines drop out.

    The interval condition becomes an equality on the day, so the join hashes instead of testing
    every line against every campaign. The calendar has one row a day with the list of its campaigns, so
    a line meets one row and is repeated after the join. It is broadcast after a count of the campaign-days;
    a larger one is dealt with the lines by day and a hash of the line, so that no day stays in one task.
    """
    days = calendar(campaign).select("date", *columns)
    listed = days.groupBy("date").agg(F.collect_list(F.struct(*columns)).alias("_campaigns"))
    if days.count() <= (broadcast_rows(days) if max_rows is None else max_rows):
        met = lines.join(F.broadcast(listed), "date")
    else:
        share = F.pmod(F.xxhash64(*lines.columns), F.lit(SHARES)).cast("int")
        copies = listed.withColumn("_share", F.explode(F.sequence(F.lit(0), F.lit(SHARES - 1))))
        met = lines.withColumn("_share", share).join(copies, ["date", "_share"])
    others = [c for c in lines.columns if c != "date"]
    return met.select("date", *others, F.explode("_campaigns").alias("_c")).select("date", *others, "_c.*")


def in_window(df: DataFrame, day: str, first: str | Column, last: str | Column) -> DataFrame:
    """Rows whose day lies in the closed interval."""
    return df.where(F.col(day).between(first, last))


def union_of_windows(lines: DataFrame, windows: Sequence[tuple[int, str, str]]) -> DataFrame:
    """The interval join spelled as one filtered scan per (camp_ord, first, last) literal."""
    parts = [
        in_window(lines, "date", F.lit(first).cast("date"), F.lit(last).cast("date")).withColumn(
            "camp_ord", F.lit(order)
        )
        for order, first, last in windows
    ]
    return reduce(DataFrame.unionByName, parts)


def campaign_columns(df: DataFrame, day_of: str = "month", periods: bool = False) -> DataFrame:
    """Date parts of both window ends, window length and type code, for rows that carry a campaign."""
    start, end = F.col("start_date"), F.col("end_date")
    new = date_parts(start, "s", day_of) | date_parts(end, "e", day_of)
    if periods:
        for prefix, day in (("s", start), ("e", end)):
            new |= {f"{prefix}_YMon": year_month(day), f"{prefix}_Yday": year_day(day)}
    new["diff_camp_days"] = span_days(start, end)
    new["campaign_type"] = encode(F.col("campaign_type"), CAMPAIGN_TYPES)
    return df.withColumns(new)
