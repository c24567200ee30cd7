import datetime as dt

import pytest
from helpers import rows
from pyspark.sql import functions as F

from offerwise.functions import scalars as sc
from offerwise.functions.codes import CATEGORIES


def one(spark, expr):
    return spark.range(1).select(expr.alias("x")).first()[0]


def test_two_digit_years_follow_the_posix_pivot(spark):
    cases = {"21/10/13": (2013, 10, 21), "01/01/69": (1969, 1, 1), "31/12/68": (2068, 12, 31), "29/02/96": (1996, 2, 29)}
    for text, day in cases.items():
        assert one(spark, sc.parse_date(F.lit(text), "dd/MM/yy")) == dt.date(*day)
    assert one(spark, sc.parse_date(F.lit("2012-08-12"))) == dt.date(2012, 8, 12)


def test_date_parts_on_the_last_day_of_a_leap_year(spark):
    day = F.lit("2012-12-31").cast("date")
    parts = spark.range(1).select(*[c.alias(n) for n, c in sc.date_parts(day, "t").items()]).first().asDict()
    assert parts == {"t_yr": 2012, "t_mon": 12, "t_wk": 1, "t_d": 366, "t_dwk": 0}
    assert one(spark, sc.date_parts(day, "s", "month")["s_d"]) == 31
    assert one(spark, sc.year_day(day)) == 201566
    assert one(spark, sc.year_month(day)) == 201212


def test_ordinal(spark):
    assert one(spark, sc.day_ordinal(F.lit("2013-07-03").cast("date"))) == 735052 == dt.date(2013, 7, 3).toordinal()


def test_codes_and_unknown_labels(spark):
    assert one(spark, sc.encode(F.lit("Dairy, Juices & Snacks"), CATEGORIES)) == 6
    assert one(spark, sc.encode(F.lit("Toys"), CATEGORIES)) is None
    assert one(spark, sc.encode(F.lit(None).cast("string"), CATEGORIES)) is None


def test_flags_and_ratios(spark):
    assert one(spark, sc.used_flag(F.lit(-0.5))) == 1
    assert one(spark, sc.used_flag(F.lit(0.0))) == 0
    assert one(spark, sc.used_flag(F.lit(None).cast("double"))) == 0
    assert one(spark, sc.ratio(F.lit(1.0), F.lit(0.0))) is None
    assert one(spark, sc.ratio(F.lit(1.0), F.lit(-0.0))) is None


@pytest.mark.parametrize("value", [float("inf"), float("-inf"), float("nan")])
def test_nonfinite_is_missing(spark, value):
    assert one(spark, sc.finite(F.lit(value))) is None


def test_unit_prices_with_zero_quantity_and_no_discount(spark):
    df = spark.createDataFrame(
        [(2.0, 10.0, -1.0, -3.0), (0.0, 10.0, -1.0, 0.0), (1.0, 5.0, 0.0, 0.0)],
        "quantity double, selling_price double, other_discount double, coupon_discount double",
    )
    full, zero, plain = sc.unit_prices(df).select("sp_qty", "tot_dis_qty", "pp_qty", "dis_p", "cdis_p").collect()
    assert tuple(full) == (5.0, -2.0, 3.0, 5.0 / 3.0 - 1, 3.0)
    assert tuple(zero) == (None, None, None, None, 0.0)
    assert tuple(plain) == (5.0, 0.0, 5.0, 0.0, None)


def test_one_hot_of_null_is_all_zero(spark):
    df = spark.createDataFrame([("Local",), (None,), ("Other",)], "b string")
    hot = sc.one_hot(F.col("b"), ("Established", "Local"), "b_")
    assert rows(df.select(*[c.alias(n) for n, c in hot.items()])) == [(0, 0), (0, 0), (0, 1)]


def test_bad_numbers_raise_unless_lenient(spark):
    assert one(spark, sc.to_number(F.lit("12"))) == 12
    assert one(spark, sc.to_number(F.lit("x"), strict=False)) is None
    with pytest.raises(Exception):
        one(spark, sc.to_number(F.lit("x")))
