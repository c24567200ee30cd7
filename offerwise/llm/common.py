"""Helpers shared by the operators of this package."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

# Rows and bytes per Arrow batch: bound what a Python worker holds when documents are long.
BATCH_ROWS = 1000
BATCH_BYTES = 32 << 20


def prepare(spark: SparkSession) -> SparkSession:
    """Let Python workers find this package where it lies beside the driver's, and bound their batches.

    On a cluster the package is installed or sent with ``--py-files``; the extra search path is then
    without effect.
    """
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = spark.sparkContext.environment
    known = env.get("PYTHONPATH", "")
    if root not in known.split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(x for x in (known, root) if x)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return spark


def read_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/documents.parquet")
