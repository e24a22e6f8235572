"""Tables between steps, in the folder that all executors share."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_own: list[str] = []


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir; where it is unset a local session gets a folder of its own, and a cluster is asked to set it."""
    if found := spark.conf.get("spark.checkpoint.dir", None):
        return found.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if not _own:
        folder = tempfile.TemporaryDirectory(prefix="tomewright-plans-")
        atexit.register(folder.cleanup)
        _own.append(f"file://{folder.name}")
    return _own[0]


def step_table(df: DataFrame) -> DataFrame:
    """df, written once and read back, so that the next step's plan starts from a table."""
    path = f"{shared_dir(df.sparkSession)}/steps/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
