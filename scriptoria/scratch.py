"""Intermediate tables in the folder that driver and executors share."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder that the session names in spark.checkpoint.dir.

    Only where that is unset and driver and executors are one process is a temporary folder made; on a
    cluster, executors would not see it.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder is None:
        if not re.fullmatch(r"local(\[.*\])?", context.master):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="checkpoints-"))
        folder = context.getCheckpointDir()
    return folder


def new_folder(spark: SparkSession) -> str:
    """A path in the shared folder, under the application's id, where nothing is yet."""
    return f"{shared_folder(spark)}/{spark.sparkContext.applicationId}/{uuid.uuid4().hex}"


def staged(df: DataFrame) -> DataFrame:
    """`df` written to a table and read back: it is computed once, whoever reads it, and a lost executor costs no earlier step."""
    path = new_folder(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
