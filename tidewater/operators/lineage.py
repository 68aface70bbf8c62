"""Cutting lineage in files that outlive any executor."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir or the one given to setCheckpointDir(). Where neither is
    set, a new temporary one, but only if all runs in one process on this machine; on a cluster it is an error."""
    given = spark.sparkContext._jsc.sc().getCheckpointDir()
    found = spark.conf.get("spark.checkpoint.dir", None) or (given.get() if given.isDefined() else None)
    if not found:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="spark-shared-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def checkpointed(df: DataFrame) -> DataFrame:
    """df checkpointed in the shared folder: iterations start from it again."""
    sc = df.sparkSession.sparkContext
    if not sc._jsc.sc().getCheckpointDir().isDefined():
        sc.setCheckpointDir(shared_dir(df.sparkSession))
    return df.checkpoint()


def stored(df: DataFrame, name: str) -> DataFrame:
    """df written as Parquet in the shared folder and read again: what is asked of it more than once is worked out once."""
    path = f"{shared_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
