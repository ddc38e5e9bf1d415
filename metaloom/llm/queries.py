"""The registered queries of this subpackage and, where SQL can express them, their SQL for DuckDB."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat_trees, decontaminate, gear_chunks, license_scan, packing, pitman_yor, quality_rules, sentence_pieces, simhash_golay, token_transducer, vector_codes, warc_index, whitening
from .common import read


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_rules.quality_rules(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))
    return judged.select("row.doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "llr")


def op1_warc_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc_index.report(read(spark, sf_dir, "pages"))


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(read(spark, sf_dir, "documents"))


def op3_simhash_golay(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash_golay.near_duplicates(read(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gear_chunks.report(read(spark, sf_dir, "documents"))


def op6_chat_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat_trees.report(read(spark, sf_dir, "conversations"))


def op7_sentence_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentence_pieces.report(read(spark, sf_dir, "documents"))


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.report(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_transducer.token_counts(read(spark, sf_dir, "documents"))


def op10_pitman_yor(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pitman_yor.score(read(spark, sf_dir, "documents"))


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.report(read(spark, sf_dir, "embeddings"))


def op12_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.report(read(spark, sf_dir, "documents"))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.report(read(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_warc_index": op1_warc_index,
    "op2_license_scan": op2_license_scan,
    "op3_simhash_golay": op3_simhash_golay,
    "op4_quality_rules": op4_quality_rules,
    "op5_substring_dedup": op5_substring_dedup,
    "op6_chat_trees": op6_chat_trees,
    "op7_sentence_pieces": op7_sentence_pieces,
    "op8_decontaminate": op8_decontaminate,
    "op9_token_counts": op9_token_counts,
    "op10_pitman_yor": op10_pitman_yor,
    "op11_vector_codes": op11_vector_codes,
    "op12_packing": op12_packing,
    "op13_whitening": op13_whitening,
}

ORACLES: dict[str, str] = {
    "op1_warc_index": warc_index.sql(),
    "op2_license_scan": license_scan.sql(),
    "op6_chat_trees": chat_trees.sql(),
    "op8_decontaminate": decontaminate.sql(),
    "op11_vector_codes": vector_codes.sql(),
}
