"""Intermediate tables written once and read many times.

A staged table cuts lineage and is read back with column pruning. It lies in the folder the cluster
names in ``spark.checkpoint.dir``, so it outlives any executor.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession

_SETTING = "spark.checkpoint.dir"
_local_folder: str | None = None


def shared_folder(spark: SparkSession) -> str:
    """The cluster's checkpoint folder; one fresh local folder only where a local session names none."""
    global _local_folder
    folder = spark.conf.get(_SETTING, None)
    if folder:
        return folder.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise ValueError(f"set {_SETTING} to a folder every executor can reach")
    if _local_folder is None:
        _local_folder = tempfile.mkdtemp(prefix="offerwise-")
    return _local_folder


_runs: dict[str, str] = {}


def run_folder(spark: SparkSession) -> str:
    """The sub-folder of this application's current run; it lives until :func:`release`."""
    app = spark.sparkContext.applicationId
    if app not in _runs:
        _runs[app] = f"{shared_folder(spark)}/offerwise-{app}-{uuid.uuid4().hex[:8]}"
    return _runs[app]


def release(spark: SparkSession) -> None:
    """Delete everything the current run has staged, through the folder's own file system.

    Call it when the run's results have been written; lazy results that read staged tables are lost.
    """
    folder = _runs.pop(spark.sparkContext.applicationId, None)
    if folder:
        delete(spark, folder)


def new_path(spark: SparkSession, label: str) -> str:
    return f"{run_folder(spark)}/{label}-{uuid.uuid4().hex}"


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and return a scan of what was written."""
    path = new_path(df.sparkSession, label)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.staged_path = path
    return out


def stage_together(tables: Mapping[str, DataFrame]) -> list[DataFrame]:
    """Stage tables that do not need each other at the same time, so that one's last tasks leave no core idle."""
    with ThreadPoolExecutor(len(tables)) as pool:
        return list(pool.map(lambda x: stage(x[1], x[0]), tables.items()))


def drop(df: DataFrame) -> None:
    """Delete one staged table before the run ends, when its last reader has written."""
    delete(df.sparkSession, df.staged_path)


def delete(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def exists(spark: SparkSession, folder: str) -> bool:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)
