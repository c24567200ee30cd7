"""Scalar expressions over columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# unix_date counts days from 1970-01-01; the proleptic ordinal counts 0001-01-01 as day 1.
ORDINAL_OF_EPOCH = 719163


def parse_date(text: Column, fmt: str | None = None) -> Column:
    """Text to date. Two-digit years follow the POSIX pivot: 69-99 are 1969-1999, 00-68 are 2000-2068."""
    if fmt is None:
        return F.to_date(text)
    day = F.to_date(text, fmt)
    if "yy" in fmt and "yyyy" not in fmt:
        day = F.when(F.year(day) >= 2069, F.add_months(day, -1200)).otherwise(day)
    return day


def date_parts(day: Column, prefix: str, day_of: str = "year") -> dict[str, Column]:
    """Year, month, ISO week, day (of the year or of the month) and weekday with Monday = 0."""
    return {
        f"{prefix}_yr": F.year(day),
        f"{prefix}_mon": F.month(day),
        f"{prefix}_wk": F.weekofyear(day),
        f"{prefix}_d": F.dayofyear(day) if day_of == "year" else F.dayofmonth(day),
        f"{prefix}_dwk": F.weekday(day),
    }


def year_month(day: Column) -> Column:
    return F.year(day) * 100 + F.month(day)


def year_day(day: Column) -> Column:
    """Year times 100 plus day of the year; days above 99 run into the next year's keys, by definition."""
    return F.year(day) * 100 + F.dayofyear(day)


def day_ordinal(day: Column) -> Column:
    return F.unix_date(day) + F.lit(ORDINAL_OF_EPOCH)


def span_days(start: Column, end: Column) -> Column:
    return F.datediff(end, start)


def used_flag(discount: Column) -> Column:
    """1 where a (non-positive) discount was given; a missing discount counts as not given."""
    return F.when(discount < 0, 1).otherwise(0)


def encode(label: Column, labels: Sequence[str]) -> Column:
    """Position of a label in ``labels``; an unknown label gives null."""
    pairs = [F.lit(x) for code, name in enumerate(labels) for x in (name, code)]
    return F.create_map(*pairs)[label]


def ratio(num: Column, den: Column) -> Column:
    """num / den, null on a zero denominator."""
    return num / F.nullif(den, F.lit(0))


def finite(value: Column) -> Column:
    """Null in place of NaN and either infinity."""
    return F.when(~F.isnan(value) & (F.abs(value) != F.lit(float("inf"))), value)


def zero_if_null(value: Column) -> Column:
    return F.coalesce(value, F.lit(0))


def to_number(value: Column, strict: bool = True) -> Column:
    return value.cast("bigint") if strict else value.try_cast("bigint")


def one_hot(value: Column, labels: Sequence[str], prefix: str) -> dict[str, Column]:
    """One 0/1 column per label; a null or unlisted value is 0 in all of them."""
    return {f"{prefix}{x}": F.when(value == F.lit(x), 1).otherwise(0) for x in labels}


def null_nonfinite(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """:func:`finite` over the named columns, by default over every float and double."""
    names = cols if cols is not None else [n for n, t in df.dtypes if t in ("double", "float")]
    return df.withColumns({n: finite(F.col(n)) for n in names})


def unit_prices(df: DataFrame) -> DataFrame:
    """Per-unit prices and discount shares of a purchase line; every zero denominator gives null.

    Discounts are non-positive and ``pp_qty`` adds them to the selling price.
    """
    per_unit = {
        "sp_qty": "selling_price",
        "other_dis_qty": "other_discount",
        "coup_dis_qty": "coupon_discount",
    }
    c = F.col
    return (
        df.withColumns({out: ratio(c(src), c("quantity")) for out, src in per_unit.items()})
        .withColumn("tot_dis_qty", c("other_dis_qty") + c("coup_dis_qty"))
        .withColumn("pp_qty", c("sp_qty") + c("tot_dis_qty"))
        .withColumns(
            {
                "dis_p": ratio(c("sp_qty"), c("pp_qty")) - 1,
                "cdis_p": ratio(c("coupon_discount"), c("other_discount")),
            }
        )
    )
