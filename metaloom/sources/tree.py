"""Listings of folders, metadata files among them, and a table of keys and values."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: The metadata files of a dataset's root, by section.
SECTIONS = ("submission", "dataset_description", "code_description", "subjects", "samples", "sites", "performances", "resources", "manifest")


def listing(spark: SparkSession, path: str, exclude: str | None = None) -> DataFrame:
    """path, name, suffix, size, updated of all files below path; contents are not read. exclude: a regular expression."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    name = F.substring_index("path", "/", -1)
    out = files.select("path", name.alias("name"), F.lower(F.regexp_extract(name, r"(\.[^.]+)$", 1)).alias("suffix"), F.col("length").alias("size"), F.col("modificationTime").alias("updated"))
    return out if exclude is None else out.filter(~F.col("path").rlike(exclude))


def metadata_files(files: DataFrame, root: str) -> DataFrame:
    """section, paths, errors: first letters in any case; manifests at any depth, others in the root; lock files are left out."""
    stem = F.regexp_extract("name", r"^([^.]*)\.", 1)
    section = F.concat(F.lower(F.substring(stem, 1, 1)), F.substring(stem, F.lit(2), F.char_length(stem)))
    below = F.regexp_replace("path", rf"^(file:)?/*{root.lstrip('/').rstrip('/')}/", "")
    found = files.withColumn("section", section).filter(F.col("section").isin(*SECTIONS) & ~F.col("name").startswith("~$"))
    found = found.filter((F.col("section") == "manifest") | ~below.contains("/"))
    errors = F.array_compact(F.array(F.when((F.count("*") > 1) & (F.first("section") != "manifest"), "several files"), F.when(F.bool_or(F.substring("name", 1, 1).rlike("[A-Z]")), "capital letter")))
    return found.groupBy("section").agg(F.array_sort(F.collect_list("path")).alias("paths"), errors.alias("errors"))


def counts(files: DataFrame) -> DataFrame:
    """suffix, n, size."""
    return files.groupBy("suffix").agg(F.count("*").alias("n"), F.sum("size").alias("size"))


class KeyValues:
    """A table of keys and values in a folder of versions; the newest is current. Every write is a whole version, so that readers never see half of one."""

    def __init__(self, spark: SparkSession, path: str, schema: str = "id string, value binary"):
        self.spark, self.path, self.schema = spark, path.rstrip("/"), schema

    def _versions(self) -> list[int]:
        fs = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        system = fs.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not system.exists(fs):
            return []
        done = [s.getPath() for s in system.listStatus(fs)]
        marked = lambda p: system.exists(self.spark._jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS"))
        return sorted(int(p.getName().removeprefix("v")) for p in done if p.getName().startswith("v") and marked(p))

    def read(self) -> DataFrame:
        versions = self._versions()
        return self.spark.read.schema(self.schema).parquet(f"{self.path}/v{versions[-1]}") if versions else self.spark.createDataFrame([], self.schema)

    def _write(self, df: DataFrame) -> None:
        df.write.parquet(f"{self.path}/v{max(self._versions(), default=0) + 1}")

    def put(self, new: DataFrame) -> None:
        """new's keys must be unique."""
        self._write(self.read().join(new.select("id"), "id", "left_anti").unionByName(new))

    def delete(self, keys: DataFrame) -> None:
        self._write(self.read().join(keys.select("id"), "id", "left_anti"))
