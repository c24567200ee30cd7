"""Table profiling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _long(df: DataFrame, values: dict[str, Column]) -> DataFrame:
    pairs = [F.struct(F.lit(name).alias("column"), v.alias("value")) for name, v in values.items()]
    return df.select(F.explode(F.array(*pairs)).alias("_p")).select("_p.*")


def null_counts(df: DataFrame) -> DataFrame:
    """Nulls per column, all columns in one pass."""
    names = df.columns
    sums = df.agg(*[F.count_if(F.col(f"`{n}`").isNull()).alias(n) for n in names])
    return _long(sums, {n: F.col(f"`{n}`") for n in names}).withColumnRenamed("value", "nulls")


def value_counts(df: DataFrame, col: str) -> DataFrame:
    """Frequency of each non-null value, most frequent first."""
    counted = df.where(F.col(col).isNotNull()).groupBy(col).count()
    return counted.orderBy(F.desc("count"), col)


def value_counts_all(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Value frequencies of several columns at once, values as text."""
    long = _long(df, {n: F.col(n).cast("string") for n in (cols or df.columns)})
    counted = long.where(F.col("value").isNotNull()).groupBy("column", "value").count()
    return counted.orderBy("column", F.desc("count"), "value")


def schema_table(df: DataFrame) -> DataFrame:
    """Column names and types in order."""
    rows = [(i, n, t) for i, (n, t) in enumerate(df.dtypes)]
    return df.sparkSession.createDataFrame(rows, "position int, column string, dtype string")


def describe_columns(df: DataFrame) -> DataFrame:
    """Names, types and null counts."""
    return schema_table(df).join(null_counts(df), "column")


def sample_head(df: DataFrame, n: int, order: Sequence[Column]) -> DataFrame:
    """First n rows in an order; every task keeps its own n first."""
    return df.orderBy(*order).limit(n)


def top_k(df: DataFrame, col: str, k: int, ties: Sequence[str] = ()) -> DataFrame:
    """The k rows with the largest values."""
    return df.orderBy(F.desc(col), *ties).limit(k)


def shape(df: DataFrame) -> DataFrame:
    """Number of rows and columns."""
    return df.agg(F.count("*").alias("n_rows")).withColumn("n_columns", F.lit(len(df.columns)))


def distinct_values(df: DataFrame, col: str) -> DataFrame:
    return df.select(col).distinct()
