"""Queries: change logs, hierarchies, event-time windows and the scheduler."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators import deltalog as H
from ..sources.tables import table
from ..streaming import schedule, windows
from .registry import query


def log(spark: SparkSession, d: str) -> DataFrame:
    """events as a log: a user's events upsert their row, an error removes it."""
    op = F.when(F.col("event_type") == "error", "remove").otherwise("upsert")
    return table(spark, d, "events").select(F.col("user_id").alias("id"), F.col("ts").alias("uct"), "event_id", op.alias("op"), "event_type", "value")


_LATEST = "SELECT user_id AS id, event_id, event_type FROM (SELECT * FROM events {where} QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1) WHERE event_type <> 'error'"


@query(_LATEST.format(where=""))
def replay_latest(spark: SparkSession, d: str) -> DataFrame:
    return H.replay(log(spark, d), "id", order=("uct", "event_id")).select("id", "event_id", "event_type")


@query(_LATEST.format(where="WHERE ts <= (SELECT min(ts) + (max(ts) - min(ts)) / 2 FROM events)"))
def replay_at(spark: SparkSession, d: str) -> DataFrame:
    """The state at half of the time."""
    x = log(spark, d)
    low, high = x.agg(F.min("uct"), F.max("uct")).first()
    half = None if low is None else (low + (high - low) / 2).isoformat()
    return H.replay(x, "id", F.lit(half).cast("timestamp_ntz"), ("uct", "event_id")).select("id", "event_id", "event_type")


def monthly(spark: SparkSession, d: str) -> DataFrame:
    """Snapshots: each user's number of events of a kind, by hundredths of all events."""
    x = table(spark, d, "events").select("user_id", "event_type", F.floor(F.col("event_id") / 100).cast("int").alias("step"))
    return x.groupBy("step", F.col("user_id").alias("id")).agg(F.min("event_type").alias("kind"))


_SNAP = "s AS (SELECT (event_id // 100)::INTEGER AS step, user_id AS id, min(event_type) AS kind FROM events GROUP BY 1, 2)"


@query(f"""WITH {_SNAP}, m AS (SELECT max(step) AS m FROM s)
SELECT s.id, s.step AS uct, s.step % 40 AS delta, 'upsert' AS op, s.kind FROM s LEFT JOIN s p ON p.id = s.id AND p.step = s.step - 1 WHERE s.step % 40 = 0 OR p.kind IS DISTINCT FROM s.kind
UNION ALL SELECT s.id, s.step + 1, (s.step + 1) % 40, 'remove', NULL FROM s LEFT JOIN s n ON n.id = s.id AND n.step = s.step + 1, m WHERE n.id IS NULL AND s.step < m AND (s.step + 1) % 40 <> 0""")
def delta_append(spark: SparkSession, d: str) -> DataFrame:
    return H.append(monthly(spark, d), "id", ["kind"], "step")


@query(f"WITH {_SNAP} SELECT id, kind FROM s WHERE step = (SELECT max(step) // 2 FROM s)")
def delta_round_trip(spark: SparkSession, d: str) -> DataFrame:
    """The snapshot at half of the steps, replayed from the log with keyframes every 5 steps."""
    s = monthly(spark, d)
    half = (s.agg(F.max("step")).first()[0] or 0) // 2
    return H.replay(H.append(s, "id", ["kind"], "step", 5), "id", F.lit(half)).select("id", "kind")


@query(f"""WITH {_SNAP} SELECT coalesce(a.step + 1, b.step) AS step, coalesce(a.id, b.id) AS id, CASE WHEN a.id IS NULL THEN 'added' WHEN b.id IS NULL THEN 'removed' ELSE 'changed' END AS change, b.kind
FROM (SELECT * FROM s WHERE step < (SELECT max(step) FROM s)) a FULL JOIN (SELECT * FROM s WHERE step > 0) b ON a.id = b.id AND a.step + 1 = b.step WHERE a.kind IS DISTINCT FROM b.kind""")
def snapshot_diff(spark: SparkSession, d: str) -> DataFrame:
    """What has changed between every two neighbouring snapshots."""
    s = monthly(spark, d)
    last = s.agg(F.max("step")).first()[0]
    return H.diff(s.filter(F.col("step") < last).withColumn("step", F.col("step") + 1), s.filter("step > 0"), ["step", "id"], ["kind"])


@query("""SELECT 'c' || c_custkey AS id, r_name || '/' || n_name || '/' || c_name AS path, 2 AS depth FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
UNION ALL SELECT 'n' || n_nationkey, r_name || '/' || n_name, 1 FROM nation JOIN region ON n_regionkey = r_regionkey UNION ALL SELECT 'r' || r_regionkey, r_name, 0 FROM region""")
def tree_path(spark: SparkSession, d: str) -> DataFrame:
    node = lambda t, kind, key, above, up, name: table(spark, d, t).select(F.concat(F.lit(kind), F.col(key).cast("string")).alias("id"), (F.concat(F.lit(above), F.col(up).cast("string")) if up else F.lit(None).cast("string")).alias("parent_id"), F.col(name).alias("name"))
    nodes = node("region", "r", "r_regionkey", "", None, "r_name").union(node("nation", "n", "n_nationkey", "r", "n_regionkey", "n_name")).union(node("customer", "c", "c_custkey", "n", "c_nationkey", "c_name"))
    return H.tree_paths(nodes).select("id", "path", "depth")


@query("""SELECT coalesce(a.k, b.k) AS id, CASE WHEN b.k IS NULL THEN 'add' WHEN a.k IS NULL THEN 'remove' ELSE coalesce(nullif(concat_ws(',', CASE WHEN a.name <> b.name THEN 'rename' END, CASE WHEN a.size <> b.size THEN 'change' END), ''), 'no-change') END AS changes
FROM (SELECT p_partkey AS k, p_name AS name, p_size AS size FROM part WHERE p_partkey % 10 <> 0) a FULL JOIN
(SELECT p_partkey AS k, CASE WHEN p_partkey % 4 = 0 THEN p_brand ELSE p_name END AS name, CASE WHEN p_partkey % 6 = 0 THEN p_size + 1 ELSE p_size END AS size FROM part WHERE p_partkey % 7 <> 0) b ON a.k = b.k""")
def change_kinds(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "part").select(F.col("p_partkey").alias("id"), F.lit("root").alias("parent_id"), F.col("p_name").alias("name"), F.col("p_size").alias("size"), "p_brand")
    index = p.filter("id % 7 <> 0").withColumn("name", F.when(F.col("id") % 4 == 0, F.col("p_brand")).otherwise(F.col("name"))).withColumn("size", F.when(F.col("id") % 6 == 0, F.col("size") + 1).otherwise(F.col("size")))
    return H.classify(p.filter("id % 10 <> 0"), index).withColumn("changes", F.array_join("changes", ","))


@query("SELECT time_bucket(INTERVAL 1 HOUR, ts) AS start, event_type, count(*) AS n FROM events GROUP BY 1, 2")
def window_tumbling(spark: SparkSession, d: str) -> DataFrame:
    return windows.tumbling(table(spark, d, "events"), "ts", "1 hour", ["event_type"], F.count("*").alias("n")).select("start", "event_type", "n")


@query("SELECT time_bucket(INTERVAL 30 MINUTE, ts) - k * INTERVAL 30 MINUTE AS start, count(*) AS n FROM events, (VALUES (0), (1)) v(k) GROUP BY 1")
def window_sliding(spark: SparkSession, d: str) -> DataFrame:
    return windows.sliding(table(spark, d, "events"), "ts", "1 hour", "30 minutes", [], F.count("*").alias("n")).select("start", "n")


@query("""SELECT user_id, min(ts) AS start, count(*) AS n FROM (SELECT *, sum(b) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS s
FROM (SELECT *, (ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) >= INTERVAL 6 HOUR)::INT AS b FROM events)) GROUP BY user_id, coalesce(s, 0)""")
def window_session(spark: SparkSession, d: str) -> DataFrame:
    return windows.session(table(spark, d, "events"), "ts", "6 hours", ["user_id"], F.count("*").alias("n")).select("user_id", "start", "n")


@query("SELECT DISTINCT user_id, event_type FROM events")
def dedupe_stream(spark: SparkSession, d: str) -> DataFrame:
    return windows.dedupe(table(spark, d, "events").select("user_id", "event_type", "ts"), ["user_id", "event_type"], "ts", "1 day").select("user_id", "event_type")


@query("""SELECT user_id, (w IS NULL AND f IS NULL) OR coalesce(u > f, u > w, false) AS due FROM (SELECT user_id, max(ts) FILTER (event_type = 'view') AS u, max(ts) FILTER (event_type = 'purchase') AS w, max(ts) FILTER (event_type = 'error') AS f FROM events GROUP BY 1)""")
def sched_enqueue(spark: SparkSession, d: str) -> DataFrame:
    last = lambda kind, name: F.max(F.when(F.col("event_type") == kind, F.col("ts"))).alias(name)
    x = table(spark, d, "events").groupBy("user_id").agg(last("view", "u"), last("purchase", "w"), last("error", "f"))
    return x.select("user_id", schedule.enqueue(F.col("u"), F.col("w"), F.col("f"), F.lit(False)).alias("due"))


def messages(spark: SparkSession, d: str) -> DataFrame:
    """events as messages to the scheduler, a key for each user."""
    kind = F.when(F.col("event_type").isin("click", "view"), "update").when(F.col("event_type") == "purchase", "start").otherwise("finish")
    n = F.row_number().over(Window.partitionBy("user_id").orderBy("ts", "event_id"))
    return table(spark, d, "events").select("user_id", n.alias("n"), kind.alias("message"), F.expr("timestampdiff(MICROSECOND, TIMESTAMP_NTZ '1970-01-01 00:00:00', ts)").alias("at"))


@query("""WITH RECURSIVE m AS (SELECT user_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS n, CASE WHEN event_type IN ('click', 'view') THEN 'update' WHEN event_type = 'purchase' THEN 'start' ELSE 'finish' END AS message, epoch_us(ts) AS sent FROM events),
f AS (SELECT DISTINCT user_id, 0::BIGINT AS n, 0 AS state, NULL::BIGINT AS queued FROM m
UNION ALL SELECT m.user_id, m.n, CASE WHEN message = 'update' AND sent <= queued THEN state WHEN message = 'update' THEN CASE WHEN state < 2 THEN 1 ELSE 3 END WHEN message = 'start' AND state = 1 THEN 2 WHEN message = 'finish' AND state = 2 THEN 0 WHEN message = 'finish' AND state = 3 THEN 1 ELSE state END,
CASE WHEN message = 'update' AND (queued IS NULL OR sent > queued) THEN sent ELSE queued END FROM f JOIN m ON m.user_id = f.user_id AND m.n = f.n + 1)
SELECT user_id, state, queued, n FROM f QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY n DESC) = 1""")
def state_fold(spark: SparkSession, d: str) -> DataFrame:
    return schedule.fold(messages(spark, d), "user_id", "n")
