"""Helpers that the operators of this subpackage share: scratch tables, words, lower case."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The six ASCII white-space characters, x20 and x09 to x0D.
SPACES = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_own: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir. Where the setting is absent, one under /tmp, but only if all runs on one machine."""
    folder = spark.conf.get("spark.checkpoint.dir", "")
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir has to name a folder that the driver and all executors share")
        app = spark.sparkContext.applicationId
        folder = _own.setdefault(app, "") or tempfile.mkdtemp(prefix="spark-", dir="/tmp")
        _own[app] = folder
    return folder.rstrip("/")


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def save(df: DataFrame, name: str) -> DataFrame:
    """Writes df as Parquet in the shared folder and reads it back: its lineage is cut, and a lost executor loses nothing."""
    path = scratch(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(saved: DataFrame) -> None:
    """Removes what save() wrote, where nothing will read it again."""
    spark = saved.sparkSession
    for folder in {file.rpartition("/")[0] for file in saved.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def checkpoint(df: DataFrame) -> DataFrame:
    """df.checkpoint(), for small tables inside loops."""
    context = df.sparkSession.sparkContext
    if not context.getCheckpointDir():
        context.setCheckpointDir(shared_dir(df.sparkSession))
    return df.checkpoint()


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value), with value computed once however often body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def ascii_lower(text: Column) -> Column:
    """Lower-cases A-Z only. lower() does just that where every character is one byte; elsewhere it would change other letters."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def spaced_words(text: Column) -> Column:
    """The runs of characters other than SPACES, in order."""
    inner = F.btrim(text, F.lit(SPACES))
    return F.when(inner == "", F.array().cast("array<string>")).otherwise(F.split(inner, r"[\x20\x09-\x0D]+"))


def plain_words(lowered: Column) -> Column:
    r"""The matches of [^\x00-\x2F\x3A-\x60\x7B-\x7F]+, in order."""
    return F.regexp_extract_all(lowered, F.lit(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"), F.lit(0))
