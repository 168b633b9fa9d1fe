"""Intermediate tables in the shared folder of the cluster."""

from __future__ import annotations

import gc
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """A new folder under the checkpoint folder that the cluster names. Only a single machine, as in tests, may name none."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        base = f"/tmp/checkpoints/{spark.sparkContext.applicationId}"
    return f"{base}/{uuid.uuid4().hex}"


def written(df: DataFrame) -> DataFrame:
    """df written as Parquet to the shared folder and read again, for tables that are used more than once."""
    path = shared_folder(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def let_go(spark: SparkSession) -> None:
    """Let Spark's cleaner delete the shuffle files of tables that nothing refers to any more, such as those that are written now."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()
