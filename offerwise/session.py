"""Session settings the jobs rely on."""

from __future__ import annotations

from pyspark.sql import SparkSession

# AQE sizes reducers at run time and splits the hot partitions of a shuffled join, so
# shuffle.partitions is only the upper bound it starts from.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # A query's shuffle files go with it and not when the driver happens to collect its garbage.
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.filterPushdown": "true",
}


def apply_settings(spark: SparkSession) -> SparkSession:
    """Give a session the adaptive settings the plans rely on and the clean-up; all of them may change while it runs."""
    for key, value in SETTINGS.items():
        if key.startswith(("spark.sql.adaptive.", "spark.sql.classic.")):
            spark.conf.set(key, value)
    return spark


def local_session(name: str, cores: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A local session for tests and benchmarks; clusters bring their own through spark-submit."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(name)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    return (
        builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .getOrCreate()
    )
