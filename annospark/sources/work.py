"""Tables that jobs of several rounds write between them, in the folder that all executors share."""

from __future__ import annotations

import functools
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


@functools.cache
def _local() -> str:
    return "file://" + tempfile.mkdtemp(prefix="annospark-work-")


def folder(spark: SparkSession) -> str:
    """What ``spark.checkpoint.dir`` names. Where it is unset, a temporary folder, on a local master alone."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path and not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return (path or _local()).rstrip("/")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as Parquet and read back, so that a lost executor costs no more than what reads it."""
    path = f"{folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
