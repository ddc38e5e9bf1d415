"""Extraction of what arrives, once for each content: a stream in micro-batches, a ledger of the digests that are done, and outputs by kind that a repeated batch overwrites."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.relational import small
from ..sources.scratch import save

Work = Callable[[DataFrame], DataFrame]
_LEDGER = "digest string, id string, kind string, batch long"


def _ledger(spark: SparkSession, out: str) -> DataFrame:
    return spark.read.schema(_LEDGER).parquet(f"{out}/done")


def extract(arriving: DataFrame, id_column: str, content: str, kind: Column, work: Mapping[str, Work], out: str, checkpoint: str, force: bool = False) -> StreamingQuery:
    """Starts the stream; it ends when all that is there has been extracted, and goes on from the checkpoint when started again.

    work: for each kind a function of (id, digest, content and the other columns) to what it tells. Of rows with equal contents (by SHA-256) the one with the smallest id is extracted, and none whose
    content an earlier batch has extracted, unless force is given. Contents of other kinds are noted in the ledger only; null contents and ids are left out. Ids tell the rows of a batch apart.

    A batch writes the results of each kind to a folder of its number, then its part of the ledger. When a batch is run again after a loss, it is judged by the ledger of the batches before it and
    overwrites the same folders, so that each result is there once; and results() shows no batch that the ledger hasn't got.
    """
    spark = arriving.sparkSession
    spark.createDataFrame([], "digest string, id string, kind string").write.mode("ignore").parquet(f"{out}/done/batch=-1")

    def one(batch: DataFrame, number: int) -> None:
        rows = batch.filter(F.col(content).isNotNull() & F.col(id_column).isNotNull()).withColumn("digest", F.sha2(F.col(content).cast("binary"), 256))
        told = rows.select("digest", F.col(id_column).alias("_id"), kind.alias("kind"))
        # contents are hashed in one pass, without shuffling them; of copies only digests and ids are combined
        firsts = told.groupBy("digest").agg(F.min_by("kind", "_id").alias("kind"), F.min("_id").alias("_id"))
        if not force:
            firsts = firsts.join(_ledger(batch.sparkSession, out).filter(F.col("batch") < number).select("digest"), "digest", "left_anti")
        firsts = save(firsts, "arrived")
        for name, does in work.items():
            chosen = firsts.filter(F.col("kind") == name).select(F.col("_id").alias(id_column), "digest")
            does(rows.join(small(chosen), [id_column, "digest"], "left_semi")).write.mode("overwrite").parquet(f"{out}/{name}/batch={number}")
        firsts.select("digest", F.col("_id").cast("string").alias("id"), "kind").write.mode("overwrite").parquet(f"{out}/done/batch={number}")

    return arriving.writeStream.foreachBatch(one).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def results(spark: SparkSession, out: str, kind: str) -> DataFrame:
    """What has been extracted of a kind, with the batch; only of batches that are wholly done."""
    whole = _ledger(spark, out).select("batch").distinct()
    return spark.read.parquet(f"{out}/{kind}").withColumn("batch", F.col("batch").cast("long")).join(small(whole), "batch", "left_semi")
