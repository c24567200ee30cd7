"""Readers and sinks for the delimited files of a promotion data set."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from offerwise.functions.scalars import parse_date
from offerwise.sources.schemas import TABLES


def read_table(spark: SparkSession, path: str, name: str) -> DataFrame:
    """Scan one CSV file or folder with a header under its fixed schema.

    Headers that differ from the schema and malformed rows fail the job.
    """
    reader = spark.read.schema(TABLES[name]).option("header", True).option("enforceSchema", False)
    return reader.option("mode", "FAILFAST").csv(path)


def read_campaigns(spark: SparkSession, path: str) -> DataFrame:
    """Campaign calendar with its day/month/year text parsed to dates."""
    return read_table(spark, path, "campaign_data").withColumns(
        {c: parse_date(F.col(c), "dd/MM/yy") for c in ("start_date", "end_date")}
    )


def write_scores(df: DataFrame, path: str) -> None:
    """Scored offers: id and redemption probability, one CSV part per task, header in each."""
    df.select("id", "redemption_status").write.mode("overwrite").option("header", True).csv(path)


def write_importance(df: DataFrame, path: str) -> None:
    """Feature importance, largest gain first."""
    (
        df.select("feature", "split", "gain")
        .orderBy(F.desc("gain"), "feature")
        .write.mode("overwrite")
        .option("header", True)
        .csv(path)
    )
