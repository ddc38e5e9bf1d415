"""Queries: documents extracted once as a stream of files, with a run that goes on from the checkpoint."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.scratch import place
from ..sources.tables import table
from ..streaming import extract as E
from .registry import query


@query("""WITH r AS (SELECT *, row_number() OVER (PARTITION BY text ORDER BY CASE WHEN lang = 'en' THEN 0 ELSE 1 END, doc_id) AS k FROM documents WHERE text IS NOT NULL AND doc_id IS NOT NULL)
SELECT doc_id, sha256(text) AS digest, lang, (CASE WHEN lang = 'en' THEN 1 + length(text) - length(replace(text, ' ', '')) ELSE length(text) END)::BIGINT AS n FROM r WHERE k = 1 AND lang IN ('en', 'de')""")
def extract_once(spark: SparkSession, d: str) -> DataFrame:
    """Different English and German texts, as files that arrive in two lots, English ones first: spaces counted in one language, characters in the other. A third run finds nothing new."""
    documents = table(spark, d, "documents")
    path, out, checkpoint = (place(spark, n) for n in ("arriving", "extracted", "progress"))
    count = lambda n: lambda rows: rows.select("doc_id", "digest", "lang", n.cast("bigint").alias("n"))
    spaces = F.lit(1) + F.char_length("text") - F.char_length(F.replace("text", F.lit(" "), F.lit("")))
    english = F.col("lang").eqNullSafe("en")
    for lot in (english, ~english, None):
        if lot is not None:
            documents.filter(lot).select("doc_id", "text", "lang").write.mode("append").parquet(path)
        stream = spark.readStream.schema(documents.select("doc_id", "text", "lang").schema).parquet(path)
        E.extract(stream, "doc_id", "text", F.col("lang"), {"en": count(spaces), "de": count(F.char_length("text"))}, out, checkpoint).awaitTermination()
    return E.results(spark, out, "en").unionByName(E.results(spark, out, "de")).drop("batch")
