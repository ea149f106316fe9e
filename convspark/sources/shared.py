"""Folders that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def new_folder(spark: SparkSession) -> str:
    """A new folder below the session's ``spark.checkpoint.dir``.

    Where that is unset, a temporary folder becomes the checkpoint folder of a local session, and any other session is
    refused, as its executors would not see the folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not (spark.conf.get("spark.master", None) or "local").startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="convspark-"))
        base = spark.sparkContext.getCheckpointDir()
    return f"{base.rstrip('/')}/convspark-{uuid.uuid4().hex}"


def saved(df: DataFrame) -> DataFrame:
    """The rows, written to a new folder and read back: computed once, however often they are used."""
    path = new_folder(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
