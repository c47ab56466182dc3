"""Intermediate tables in the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


#: The temporary folder of a local session whose setting names none: it cannot be set once a session runs.
_OWN_ROOT: list[str] = []


def fresh(spark: SparkSession, name: str) -> str:
    """A new path under spark.checkpoint.dir. Only a local[...] session without that setting gets a temporary folder."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        if not _OWN_ROOT:
            _OWN_ROOT.append("file://" + tempfile.mkdtemp(prefix="evidar-"))
        root = _OWN_ROOT[0]
    return f"{root.rstrip('/')}/evidar-{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


def staged(df: DataFrame, name: str) -> DataFrame:
    """df written under spark.checkpoint.dir and read again: its plan starts anew there."""
    path = fresh(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
