"""A corpus pipeline: quality rules, near-dedup, substring dedup, decontamination, encoding.

Each stage takes what the one before has kept, whole, and its decisions take effect: documents that the rules reject go;
of each group of near-duplicates one stays; repeated runs are cut from texts; contaminated documents go; what is left is
encoded, and decoded again. Stages add no row. Nulls, ties and repeated rows fall under each operator's own definitions.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from metaloom.llm import decontaminate, gear_chunks, quality_rules, sentence_pieces, simhash_golay
from metaloom.llm.common import read, save

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """docs that the quality rules keep; the model is fitted on these docs and the table labels."""
    judged = quality_rules.quality_rules(docs, read(spark, sf_dir, "labels"))
    # a filter on kept alone would be pushed below the projection, and every rule computed twice
    return judged.select("row.*", (F.col("kept") & (F.monotonically_increasing_id() >= 0)).alias("_kept")).filter("_kept").drop("_kept")


def distinct_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies (linked by the fingerprints of op3_simhash_golay, or by a similarity of 0.8 or more of five-word shingles) the row with the smallest doc_id; null texts and texts without words are one group."""
    return simhash_golay.keep_one(docs, simhash_golay.near_duplicates_or_copies)


def unrepeated_text(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """docs with runs of chunks that another document owns cut from text; rows stay, also those whose text is null or becomes empty."""
    return gear_chunks.substring_dedup(docs)


def uncontaminated_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """docs that hold no window of the table benchmark; null texts hold none."""
    return decontaminate.drop_contaminated(docs, read(spark, sf_dir, "benchmark"))


def encoded_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_pieces, ids and decoded, the text that the ids give back."""
    return sentence_pieces.encode(docs).select("doc_id", F.size("ids").cast("bigint").alias("n_pieces"), "ids", "decoded")


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", good_documents),
    ("near_dedup", distinct_documents),
    ("substring_dedup", unrepeated_text),
    ("decontaminate", uncontaminated_documents),
    ("sentence_pieces", encoded_documents),
]

#: Neither fingerprints nor rolling hashes nor pieces can be had in SQL.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = save(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
