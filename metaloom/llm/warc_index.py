r"""WARC archives and their merged capture index.

Pages are written as WARC/1.1 records, gzipped, by Spark's text writer: a record is a row, and the two empty lines that
end it are the line separator. Each file is sorted by URL key and date, so it is one locally sorted run. Files are bounded
by bytes: pages are written by classes of size, the largest of which is put into as few records a file as FILE_BYTES
allow. A payload of MIN_REVISIT bytes or more that several pages have is written once, for the largest page_id; the others
are revisit records that refer to it. Copies are found on digests alone; those of a hot payload are dealt over SALTS tasks.

Archives are read back by record lengths, never by separators, and every payload's digest is computed anew and compared
with its header. The captures of all runs are then merged externally: dealt by ranges of (URL key, date, page_id), each
range gets its stretch of every run, in the run's order, and merges these k stretches with a loser tree. A key that fills
several ranges stays in order across them, and its captures are numbered through with the counts of the ranges before.

Defined cases: null html is an empty payload; a null url has the key ")"; a null page_id refers to nothing and is never
referred to unless all pages with that payload have none; of repeated rows with the largest page_id each is a response;
line ends in a url are percent-encoded, all else in it comes back as it was; records are limited by a row's 2 GB; further
columns are ignored.
"""

from __future__ import annotations

import gzip
import hashlib
import io
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import save, scratch

MIN_REVISIT = 1000
#: Payload bytes in a file (one record may have more), records in a file, and captures in a range, at most about.
FILE_BYTES, FILE_RECORDS, RANGE_ROWS = 256_000_000, 5000, 200_000
#: A payload is hot if more pages have it, and more than one in HOT_SHARE of all copies; over how many tasks these are dealt.
HOT_COPIES, HOT_SHARE, SALTS = 1000, 10_000, 64
#: The date of page 0; each page_id is a second later.
EPOCH = 1_704_067_200
END = "\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def url_key(url: Column) -> Column:
    """Host labels in reverse, ")", path and query; without scheme, www, default port and fragment, in lower case."""
    plain = F.regexp_replace(F.regexp_replace(F.lower(F.coalesce(url, F.lit(""))), r"#.*$", ""), r"^[a-z][a-z0-9+.-]*://", "")
    host = F.regexp_replace(F.regexp_replace(F.regexp_extract(plain, r"^[^/?]*", 0), r":(80|443)$", ""), r"^www[0-9]*\.", "")
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.")), ","), F.lit(")"), F.regexp_replace(plain, r"^[^/?]*", ""))


def _date(page_id: Column) -> Column:
    at = F.timestamp_seconds(F.lit(EPOCH) + F.pmod(F.coalesce(page_id, F.lit(0)), F.lit(1_000_000_000)))
    return F.date_format(F.to_utc_timestamp(at, F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss'Z'")


def write_archives(pages: DataFrame, path: str) -> None:
    """pages: page_id, url, html. Writes a record for each row under path, in a folder for each class of size."""
    payload = F.coalesce("html", F.lit(""))
    # records of up to FILE_BYTES / FILE_RECORDS bytes are class 0, and each further class has records of up to four times the size
    least = FILE_BYTES // FILE_RECORDS
    of_size = lambda n: F.when(n <= least, 0).otherwise(F.ceil(F.log(4.0, n / F.lit(least)))).cast("int")
    classes = [r.c for r in pages.select(of_size(F.octet_length(payload)).alias("c")).distinct().collect()]  # 16 at most
    for c in sorted(classes) or [0]:
        some = pages.filter(of_size(F.octet_length(payload)) == c).select("page_id", "url", payload.alias("payload"))
        _write_records(some, f"{path}/class={c}", max(1, FILE_RECORDS // 4**c))


def _write_records(pages: DataFrame, path: str, file_records: int) -> None:
    rows = pages.select("*", F.sha1(F.col("payload").cast("binary")).alias("digest"), F.octet_length("payload").alias("n"))
    copies = rows.filter(F.col("n") >= MIN_REVISIT).groupBy("digest").agg(F.max("page_id").alias("origin"), F.count("*").alias("copies")).filter("copies > 1")
    copies = save(copies, "warc-copies")
    least = max(HOT_COPIES, (copies.agg(F.sum("copies")).first()[0] or 0) / HOT_SHARE)
    is_hot = F.col("copies") > least  # holds for fewer than HOT_SHARE digests
    rows = rows.join(F.broadcast(copies.filter(is_hot).select("digest", F.lit(True).alias("hot"))), "digest", "left")
    salt = F.when(F.col("hot"), F.pmod(F.xxhash64("page_id", "url"), F.lit(SALTS))).otherwise(0).cast("int")
    dealt = copies.select("digest", "origin", F.explode(F.sequence(F.lit(0), F.when(is_hot, SALTS - 1).otherwise(0))).alias("salt"))
    told = rows.withColumn("salt", salt).join(dealt, ["digest", "salt"], "left")
    revisit = F.col("origin").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("origin"))
    name = lambda c: F.concat(F.lit("<urn:x-page:"), F.coalesce(F.col(c).cast("string"), F.lit("")), F.lit(">"))
    line = lambda key, value: F.concat(F.lit(f"{key}: "), value)
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("n").cast("string"), F.lit(END))
    block = F.when(revisit, F.lit("")).otherwise(F.concat(http, F.col("payload")))
    clean = F.regexp_replace(F.regexp_replace("url", "\r", "%0D"), "\n", "%0A")
    head = F.concat_ws(
        "\r\n", F.lit("WARC/1.1"), line("WARC-Type", F.when(revisit, "revisit").otherwise("response")), line("WARC-Record-ID", name("page_id")), line("WARC-Target-URI", clean), line("WARC-Date", _date(F.col("page_id"))),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))), F.when(revisit, line("WARC-Profile", F.lit(PROFILE))), F.when(revisit, line("WARC-Refers-To", name("origin"))),
        F.lit("Content-Type: application/http;msgtype=response"), line("Content-Length", F.octet_length(block).cast("string")),
    )
    runs = told.sortWithinPartitions(url_key(clean), _date(F.col("page_id")), "page_id")
    runs.select(F.concat(head, F.lit(END), block).alias("value")).write.option("lineSep", END).option("compression", "gzip").option("maxRecordsPerFile", file_records).text(path)


def records(stream: io.BufferedIOBase) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers (names in lower case) and block of each record."""
    while first := stream.readline():
        if not first.strip():
            continue
        if not first.startswith(b"WARC/"):
            raise ValueError(f"not a WARC record: {first[:40]!r}")
        head = {}
        while (line := stream.readline()).strip():
            key, _, value = line.removesuffix(b"\n").removesuffix(b"\r").decode().partition(":")
            head[key.strip().lower()] = value.removeprefix(" ")
        yield head, stream.read(int(head["content-length"]))


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """run (the file), place, page_id, url, captured, record_type, refers_to, digest, payload_bytes (null for revisits): a row for each record."""
    schema = "run string, place bigint, page_id bigint, url string, captured string, record_type string, refers_to bigint, digest string, payload_bytes bigint"
    names = [f.split()[0] for f in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = lambda x: int(x[12:-1]) if x and x[12:-1] else None
        for batch in batches:
            for file, content in zip(batch.column("path"), batch.column("content")):
                rows = []
                stream = io.BufferedReader(gzip.GzipFile(fileobj=io.BytesIO(content.as_buffer())))
                for place, (head, block) in enumerate(records(stream)):
                    digest, size = head["warc-payload-digest"].removeprefix("sha1:"), None
                    if head["warc-type"] == "response":
                        payload = memoryview(block)[block.index(END.encode()) + len(END) :]
                        size = len(payload)
                        if hashlib.sha1(payload).hexdigest() != digest:
                            raise ValueError(f"{head['warc-record-id']}: the payload does not have its digest")
                    rows.append((file.as_py(), place, number(head["warc-record-id"]), head.get("warc-target-uri"), head["warc-date"], head["warc-type"], number(head.get("warc-refers-to")), digest, size))
                columns = zip(*rows) if rows else [()] * len(names)
                kinds = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds)], names)

    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.gz").load(path).select("path", "content").mapInArrow(run, schema)


class LoserTree:
    """Merges sorted lists of comparable keys: each inner node holds the loser of its match, the winner goes up."""

    def __init__(self, runs: list[list]):
        self.runs, self.at = runs, [0] * len(runs)
        self.losers = [-1] * len(runs)
        for k in range(len(runs)):
            self._play(k)

    def _beats(self, a: int, b: int) -> bool:
        """An empty run loses to all; a node without a run so far (-1) wins, and so holds the first that comes."""
        if a < 0 or b < 0:
            return a < 0
        if self.at[b] >= len(self.runs[b]):
            return True
        return self.at[a] < len(self.runs[a]) and self.runs[a][self.at[a]] < self.runs[b][self.at[b]]

    def _play(self, k: int) -> None:
        node = (k + len(self.runs)) // 2
        while node:
            if self._beats(self.losers[node], k):
                self.losers[node], k = k, self.losers[node]
            node //= 2
        self.losers[0] = k

    def __iter__(self) -> Iterator[tuple[int, int]]:
        """Run and place of each key, in order."""
        while self.runs and self.at[k := self.losers[0]] < len(self.runs[k]):
            yield k, self.at[k]
            self.at[k] += 1
            self._play(k)


def merge_index(captures: DataFrame) -> DataFrame:
    """captures: run, place, urlkey, captured, page_id. Adds part and history_pos: in global order, part by part, each key's captures are numbered from 1."""
    captures = save(captures, "warc-runs")
    order = ["urlkey", "captured", "page_id"]
    n = max(captures.sparkSession.sparkContext.defaultParallelism, -(-captures.count() // RANGE_ROWS))
    schema = captures.schema

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        table = pa.Table.from_batches(list(batches)) if (batches := [b for b in batches if b.num_rows]) else None
        if table is None:
            return
        runs: list[list] = []
        ends, last = [], None
        for k, (run, *key) in enumerate(zip(*(table.column(c).to_pylist() for c in ("run", *order)))):
            if run != last:
                runs.append([])
                ends.append(k)
                last = run
            page = key[2]
            runs[-1].append((key[0], key[1], page is not None, page or 0))
        take, numbers, before, count = [], [], None, 0
        for run, place in LoserTree(runs):
            key = runs[run][place][0]
            count = count + 1 if key == before else 1
            before = key
            take.append(ends[run] + place)
            numbers.append(count)
        merged = table.take(pa.array(take, pa.int64())).append_column("part", pa.array([part] * len(take), pa.int32())).append_column("number", pa.array(numbers, pa.int64()))
        yield from merged.to_batches()

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    merged = save(captures.repartitionByRange(n, *order).sortWithinPartitions("run", "place").mapInArrow(merge, f"{fields}, part int, number bigint"), "warc-merged")
    counts = merged.groupBy("urlkey", "part").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("urlkey").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    offsets = counts.withColumn("before", before).filter("before > 0").drop("n")
    return merged.join(offsets, ["urlkey", "part"], "left").withColumn("history_pos", F.col("number") + F.coalesce("before", F.lit(0))).drop("number", "before")


def report(pages: DataFrame) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to, urlkey, captured, history_pos: a row for each page, from the archives."""
    spark = pages.sparkSession
    path = scratch(spark, "archives")
    write_archives(pages, path)
    found = merge_index(read_archives(spark, path).withColumn("urlkey", url_key(F.col("url"))).drop("url"))
    whole = found.filter("record_type = 'response'").groupBy(F.col("page_id").alias("refers_to"), "digest").agg(F.max("payload_bytes").alias("full"))
    out = found.join(whole, ["refers_to", "digest"], "left")
    size = F.coalesce("payload_bytes", "full")
    return out.select("page_id", size.alias("payload_bytes"), F.col("digest").alias("payload_digest"), "record_type", "refers_to", "urlkey", "captured", "history_pos")


def sql() -> str:
    """report() for DuckDB, from the pages themselves."""
    return rf"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html, lower(coalesce(url, '')) AS u FROM pages),
q AS (SELECT page_id, strlen(html)::BIGINT AS n, sha1(html) AS digest, regexp_replace(regexp_replace(u, '#.*$', ''), '^[a-z][a-z0-9+.-]*://', '') AS u,
      strftime(make_timestamp(({EPOCH} + coalesce(page_id, 0) % 1000000000) * 1000000), '%Y-%m-%dT%H:%M:%SZ') AS captured FROM p),
r AS (SELECT *, max(page_id) OVER (PARTITION BY digest) AS origin,
      regexp_replace(regexp_replace(regexp_extract(u, '^[^/?]*'), ':(80|443)$', ''), '^www[0-9]*\.', '') AS host FROM q),
k AS (SELECT *, n >= {MIN_REVISIT} AND page_id <> origin AS again, array_to_string(list_reverse(string_split(host, '.')), ',') || ')' || regexp_replace(u, '^[^/?]*', '') AS urlkey FROM r)
SELECT page_id, n AS payload_bytes, digest AS payload_digest, CASE WHEN again THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN again THEN origin END AS refers_to, urlkey, captured, row_number() OVER (PARTITION BY urlkey ORDER BY captured, page_id) AS history_pos
FROM k"""
