"""Sinks: JSON, JSON-LD, TSV, XML and N-Triples text, and versions that are published at once."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def json_rows(df: DataFrame) -> DataFrame:
    """A JSON object for each row, keys sorted."""
    return df.select(F.to_json(F.struct(*sorted(df.columns))).alias("value"))


def write_json(df: DataFrame, path: str) -> None:
    json_rows(df).write.text(path)


def json_ld(df: DataFrame, context: Mapping[str, str], id_column: str, kind: str) -> DataFrame:
    """A JSON-LD node for each row, with its context, @id and @type."""
    fields = [F.lit(json.dumps(dict(sorted(context.items())))).alias("_c"), F.to_json(F.struct(F.col(id_column).alias("@id"), F.lit(kind).alias("@type"), *sorted(c for c in df.columns if c != id_column))).alias("_n")]
    return df.select(*fields).select(F.concat(F.lit('{"@context":'), "_c", F.lit(","), F.substring("_n", F.lit(2), F.char_length("_n"))).alias("value"))


def flat(value: Column, kind: str) -> Column:
    """One line of text: lists joined by commas, tabs and line ends as spaces."""
    text = F.array_join(value.cast("array<string>"), ",") if kind.startswith("array") else value.cast("string")
    return F.translate(text, "\t\r\n", "   ")


def write_tsv(df: DataFrame, path: str, columns: Sequence[str] | None = None) -> None:
    names = list(columns or df.columns)
    kinds = dict(df.dtypes)
    df.select(*(flat(F.col(c), kinds[c]).alias(c) for c in names)).write.option("sep", "\t").option("header", True).option("emptyValue", "").option("quote", "\u0000").option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)


def write_xml(df: DataFrame, path: str, row: str = "record", root: str = "records") -> None:
    df.write.format("xml").option("rowTag", row).option("rootTag", root).save(path)


def ntriples(triples: DataFrame) -> DataFrame:
    """A line for each of s, p, o, o_kind (iri, blank, or else a literal)."""
    name = lambda c: F.when(F.col(c).startswith("_:"), F.col(c)).otherwise(F.concat(F.lit("<"), F.col(c), F.lit(">")))
    text = F.col("o")
    for a, b in (("\\", "\\\\"), ('"', '\\"'), ("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t")):
        text = F.replace(text, F.lit(a), F.lit(b))
    o = F.when(F.col("o_kind").isin("iri", "blank"), name("o")).otherwise(F.concat(F.lit('"'), text, F.lit('"')))
    return triples.select(F.concat_ws(" ", name("s"), name("p"), o, F.lit(".")).alias("value"))


def publish(df: DataFrame, folder: str, version: str) -> str:
    """Writes df as a version and then points LATEST at it; readers of latest() see the old version until the new one is whole."""
    spark = df.sparkSession
    df.write.parquet(f"{folder}/{version}")
    jvm = spark._jvm.org.apache.hadoop.fs
    new, to = jvm.Path(f"{folder}/LATEST.{version}"), jvm.Path(f"{folder}/LATEST")
    system = to.getFileSystem(spark._jsc.hadoopConfiguration())
    stream = system.create(new, True)
    stream.write(bytearray(version.encode()))
    stream.close()
    context = jvm.FileContext.getFileContext(to.toUri(), spark._jsc.hadoopConfiguration())
    renames = spark.sparkContext._gateway.new_array(spark._jvm.org.apache.hadoop.fs.Options.Rename, 1)
    renames[0] = getattr(spark._jvm, "org.apache.hadoop.fs.Options$Rename").OVERWRITE
    context.rename(new, to, renames)
    return f"{folder}/{version}"


def latest(spark: SparkSession, folder: str) -> DataFrame:
    version = spark.read.text(f"{folder}/LATEST").first().value
    return spark.read.parquet(f"{folder}/{version}")
