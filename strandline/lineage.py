"""Cutting lineage in a place that every executor can read."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder that all executors share: spark.checkpoint.dir, or one of its own where a session of a single machine names none."""
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not named:
        if not context.master.startswith("local[") and context.master != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="spark-checkpoint-"))
        named = context.getCheckpointDir()
    return named


def cut_lineage(df: DataFrame) -> DataFrame:
    """df written to the shared folder, so that a lost executor costs one stage. Spark removes the files with the last use of df if spark.cleaner.referenceTracking.cleanCheckpoints is on."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


def new_folder(spark: SparkSession, name: str) -> str:
    """A path of its own in the shared folder."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def remove_folder(spark: SparkSession, path: str) -> None:
    """Deletes a folder of the shared folder; one that isn't there is no error."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
