"""Tables written in between: a lineage ends there, and a lost executor loses nothing."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_own: dict[str, str] = {}


def folder(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir. Where the setting is absent, one under /tmp, but only if all runs on one machine."""
    if found := spark.conf.get("spark.checkpoint.dir", ""):
        return found.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir has to name a folder that the driver and all executors share")
    app = spark.sparkContext.applicationId
    if app not in _own:
        _own[app] = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
    return _own[app]


def place(spark: SparkSession, name: str) -> str:
    """A new path in the folder."""
    return f"{folder(spark)}/{name}-{uuid.uuid4().hex}"


def save(df: DataFrame, name: str = "table") -> DataFrame:
    """df, written as Parquet and read back."""
    path = place(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
