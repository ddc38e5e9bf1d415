"""Extraction from a stream that is lost and started again."""

import pytest
from pyspark.sql import functions as F

from metaloom.streaming import extract as E


def test_a_lost_batch_is_run_again_and_nothing_is_there_twice(spark, tmp_path):
    files, out, progress = (str(tmp_path / n) for n in ("files", "out", "progress"))
    put = lambda rows: spark.createDataFrame(rows, "id long, kind string, text string").coalesce(1).write.mode("append").parquet(files)
    put([(1, "a", "one"), (2, "a", "two"), (3, "b", "one"), (4, "b", "three"), (5, "c", "four"), (6, "a", None), (None, "a", "none")])
    lose = {"before": True}

    def work(rows):
        return rows.select("id", "digest", F.upper("text").alias("said"))

    def broken(rows):
        if lose["before"]:
            raise RuntimeError("lost")
        return work(rows)

    def run(force=False, to=out, at=progress):
        stream = spark.readStream.schema("id long, kind string, text string").option("maxFilesPerTrigger", 1).parquet(files)
        E.extract(stream, "id", "text", F.col("kind"), {"a": work, "b": broken}, to, at, force).awaitTermination()

    told = lambda kind, to=out: sorted((r.id, r.said) for r in E.results(spark, to, kind).collect())
    with pytest.raises(Exception, match="lost"):
        run()
    # a was written, but its batch isn't done
    assert told("a") == []
    lose["before"] = False
    run()
    first = ([(1, "ONE"), (2, "TWO")], [(4, "THREE")])
    assert (told("a"), told("b")) == first
    run()
    assert (told("a"), told("b")) == first
    put([(7, "b", "two"), (8, "b", "five"), (9, "b", "five"), (0, "c", "six"), (10, "a", "")])
    run()
    assert (told("a"), told("b")) == ([(1, "ONE"), (2, "TWO"), (10, "")], [(4, "THREE"), (8, "FIVE")])
    assert sorted((r.id, r.kind) for r in E._ledger(spark, out).collect()) == [("0", "c"), ("1", "a"), ("10", "a"), ("2", "a"), ("4", "b"), ("5", "c"), ("8", "b")]
    again = str(tmp_path / "again")
    run(True, again, str(tmp_path / "anew"))
    assert sorted(told("b", again)) == [(4, "THREE"), (7, "TWO"), (8, "FIVE")]


def test_an_empty_stream(spark, tmp_path):
    path, out = str(tmp_path / "files"), str(tmp_path / "out")
    spark.createDataFrame([], "id long, kind string, text string").write.parquet(path)
    stream = spark.readStream.schema("id long, kind string, text string").parquet(path)
    E.extract(stream, "id", "text", F.col("kind"), {"a": lambda r: r.select("id", "digest")}, out, str(tmp_path / "p")).awaitTermination()
    assert E._ledger(spark, out).count() == 0
