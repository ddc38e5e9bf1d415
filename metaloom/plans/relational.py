"""Queries: selections, joins, sets, groups and windows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.relational import as_of, contained, last_wins, nearest, upsert, within
from ..sources.tables import table
from .registry import query


@query("SELECT p_partkey, p_name, p_size FROM part WHERE p_size > 25 AND p_brand <> 'Brand#11'")
def proj_filter(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "part").filter("p_size > 25 AND p_brand <> 'Brand#11'").select("p_partkey", "p_name", "p_size")


@query("SELECT DISTINCT p_brand, p_type FROM part")
def distinct(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "part").select("p_brand", "p_type").distinct()


@query("SELECT p_partkey, p_size, p_retailprice FROM part ORDER BY nullif(p_size, 50) DESC NULLS LAST, p_retailprice DESC, p_partkey LIMIT 25")
def topk_null_last(spark: SparkSession, d: str) -> DataFrame:
    order = [F.nullif(F.col("p_size"), F.lit(50)).desc_nulls_last(), F.desc("p_retailprice"), "p_partkey"]
    return table(spark, d, "part").orderBy(*order).limit(25).select("p_partkey", "p_size", "p_retailprice")


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 100")
def limit_sorted(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "orders").orderBy(F.desc("o_totalprice"), "o_orderkey").limit(100).select("o_orderkey", "o_totalprice")


@query("SELECT o_orderkey, c_name, c_mktsegment FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_orderstatus = 'F'")
def join_inner(spark: SparkSession, d: str) -> DataFrame:
    o, c = table(spark, d, "orders").filter("o_orderstatus = 'F'"), table(spark, d, "customer")
    return o.join(c, o.o_custkey == c.c_custkey).select("o_orderkey", "c_name", "c_mktsegment")


@query("SELECT c_custkey, count(o_orderkey) AS n_orders FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY c_custkey")
def join_left(spark: SparkSession, d: str) -> DataFrame:
    o, c = table(spark, d, "orders"), table(spark, d, "customer")
    return c.join(o, o.o_custkey == c.c_custkey, "left").groupBy("c_custkey").agg(F.count("o_orderkey").alias("n_orders"))


@query("""SELECT coalesce(c_nationkey, s_nationkey) AS nation, n_customers, n_suppliers
FROM (SELECT c_nationkey, count(*) AS n_customers FROM customer WHERE c_acctbal > 5000 GROUP BY 1)
FULL JOIN (SELECT s_nationkey, count(*) AS n_suppliers FROM supplier WHERE s_acctbal > 5000 GROUP BY 1) ON c_nationkey = s_nationkey""")
def join_full(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "customer").filter("c_acctbal > 5000").groupBy("c_nationkey").agg(F.count("*").alias("n_customers"))
    s = table(spark, d, "supplier").filter("s_acctbal > 5000").groupBy("s_nationkey").agg(F.count("*").alias("n_suppliers"))
    return c.join(s, c.c_nationkey == s.s_nationkey, "full").select(F.coalesce("c_nationkey", "s_nationkey").alias("nation"), "n_customers", "n_suppliers")


@query("SELECT p_partkey FROM part WHERE EXISTS (SELECT 1 FROM lineitem WHERE l_partkey = p_partkey AND l_quantity > 45)")
def join_semi(spark: SparkSession, d: str) -> DataFrame:
    p, x = table(spark, d, "part"), table(spark, d, "lineitem").filter("l_quantity > 45")
    return p.join(x, p.p_partkey == x.l_partkey, "left_semi").select("p_partkey")


@query("SELECT c_custkey FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 400000)")
def join_anti(spark: SparkSession, d: str) -> DataFrame:
    c, o = table(spark, d, "customer"), table(spark, d, "orders").filter("o_totalprice > 400000")
    return c.join(o, c.c_custkey == o.o_custkey, "left_anti").select("c_custkey")


@query("SELECT a.s_suppkey AS first_key, b.s_suppkey AS second_key FROM supplier a JOIN supplier b ON a.s_nationkey = b.s_nationkey AND a.s_suppkey < b.s_suppkey AND abs(a.s_acctbal - b.s_acctbal) < 500")
def join_theta(spark: SparkSession, d: str) -> DataFrame:
    s = table(spark, d, "supplier").select("s_suppkey", "s_nationkey", "s_acctbal")
    near = within(s, s, ["s_nationkey"], "s_acctbal", 500.0).filter("a.s_suppkey < b.s_suppkey")
    return near.select(F.col("a.s_suppkey").alias("first_key"), F.col("b.s_suppkey").alias("second_key"))


@query("SELECT r_name, v.status, (SELECT count(*) FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey WHERE n_regionkey = r_regionkey AND o_orderstatus = v.status) AS n_orders FROM region, (VALUES ('O'), ('F'), ('X')) v(status)")
def join_values(spark: SparkSession, d: str) -> DataFrame:
    """A fixed list of values joined with the five regions; what has no order counts 0."""
    o, c, n, r = (table(spark, d, t) for t in ("orders", "customer", "nation", "region"))
    status = F.explode(F.array(F.lit("O"), F.lit("F"), F.lit("X"))).alias("status")
    counts = o.join(c, o.o_custkey == c.c_custkey).join(F.broadcast(n), c.c_nationkey == n.n_nationkey).groupBy(F.col("n_regionkey").alias("r_regionkey"), F.col("o_orderstatus").alias("status")).agg(F.count("*").alias("n"))
    return r.select("r_regionkey", "r_name", status).join(counts, ["r_regionkey", "status"], "left").select("r_name", "status", F.coalesce("n", F.lit(0)).alias("n_orders"))


@query(r"""SELECT DISTINCT doc_id, item FROM (SELECT doc_id, ' ' || regexp_replace(text, '\s+', ' ', 'g') || ' ' AS t FROM documents WHERE text IS NOT NULL)
JOIN (SELECT DISTINCT array_to_string(string_split_regex(trim(text), '\s+')[1:3], ' ') AS item FROM benchmark) ON contains(t, ' ' || item || ' ')""")
def join_contains(spark: SparkSession, d: str) -> DataFrame:
    """Which documents contain the first three words of a benchmark item."""
    terms = table(spark, d, "benchmark").select(F.array_join(F.slice(F.split(F.trim("text"), r"\s+"), 1, 3), " ").alias("item")).distinct()
    return contained(table(spark, d, "documents").select("doc_id", "text"), "text", terms, "item").select("doc_id", "item").distinct()


@query("""SELECT p_type, arg_min(v, struct_pack(d := levenshtein(p_type, v), v := v)) AS nearest, min(levenshtein(p_type, v))::INTEGER AS distance
FROM (SELECT DISTINCT p_type FROM part), (VALUES ('ECONOMY TIN'), ('LARGE STEEL'), ('PROMO BRASS'), ('SMALL COPPER'), ('STANDARD NICKEL')) c(v) GROUP BY p_type""")
def nearest_value(spark: SparkSession, d: str) -> DataFrame:
    names = ["ECONOMY TIN", "LARGE STEEL", "PROMO BRASS", "SMALL COPPER", "STANDARD NICKEL"]
    return nearest(table(spark, d, "part").select("p_type").distinct(), "p_type", names, F.lit(1000))


@query("SELECT c_nationkey AS nation FROM customer UNION SELECT s_nationkey FROM supplier")
def set_union(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "customer").select(F.col("c_nationkey").alias("nation")).union(table(spark, d, "supplier").select("s_nationkey")).distinct()


@query("SELECT c_nationkey AS nation FROM customer INTERSECT SELECT s_nationkey FROM supplier")
def set_intersect(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "customer").select(F.col("c_nationkey").alias("nation")).intersect(table(spark, d, "supplier").select("s_nationkey"))


@query("SELECT p_partkey FROM part EXCEPT SELECT l_partkey FROM lineitem WHERE l_quantity > 47")
def set_except(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "part").select("p_partkey").subtract(table(spark, d, "lineitem").filter("l_quantity > 47").select("l_partkey"))


@query("""SELECT l_returnflag, l_linestatus, sum(l_quantity) AS sum_qty, round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue, count(*) AS n
FROM lineitem WHERE l_shipdate <= TIMESTAMP '1998-09-02' GROUP BY 1, 2""")
def agg_group(spark: SparkSession, d: str) -> DataFrame:
    x = table(spark, d, "lineitem").filter(F.col("l_shipdate") <= F.lit("1998-09-02").cast("timestamp"))
    revenue = F.round(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))), 2)
    return x.groupBy("l_returnflag", "l_linestatus").agg(F.sum("l_quantity").alias("sum_qty"), revenue.alias("revenue"), F.count("*").alias("n"))


@query("SELECT l_suppkey, count(*) AS n FROM lineitem GROUP BY l_suppkey HAVING count(*) > 600")
def agg_having(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "lineitem").groupBy("l_suppkey").agg(F.count("*").alias("n")).filter("n > 600")


@query("SELECT l_shipmode_key, count(DISTINCT l_partkey) AS n_parts, count(DISTINCT l_suppkey) AS n_suppliers FROM (SELECT l_returnflag AS l_shipmode_key, l_partkey, l_suppkey FROM lineitem) GROUP BY 1")
def agg_distinct(spark: SparkSession, d: str) -> DataFrame:
    x = table(spark, d, "lineitem").withColumnRenamed("l_returnflag", "l_shipmode_key")
    return x.groupBy("l_shipmode_key").agg(F.countDistinct("l_partkey").alias("n_parts"), F.countDistinct("l_suppkey").alias("n_suppliers"))


@query("SELECT l_returnflag, l_linestatus, count(*) AS n, grouping(l_returnflag, l_linestatus)::BIGINT AS level FROM lineitem GROUP BY ROLLUP (l_returnflag, l_linestatus)")
def agg_rollup(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "lineitem").rollup("l_returnflag", "l_linestatus").agg(F.count("*").alias("n"), F.grouping_id().alias("level"))


@query("SELECT o_orderstatus, o_orderpriority, count(*) AS n FROM orders GROUP BY CUBE (o_orderstatus, o_orderpriority)")
def agg_cube(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "orders").cube("o_orderstatus", "o_orderpriority").agg(F.count("*").alias("n"))


@query("SELECT p_brand, p_size, count(*) AS n FROM part GROUP BY GROUPING SETS ((p_brand), (p_size), ())")
def agg_grouping_sets(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "part")
    return p.groupingSets([["p_brand"], ["p_size"], []], "p_brand", "p_size").agg(F.count("*").alias("n"))


@query("SELECT n_regionkey, string_agg(n_name, ';' ORDER BY n_name) AS names FROM nation GROUP BY n_regionkey")
def agg_listagg(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "nation").groupBy("n_regionkey").agg(F.array_join(F.array_sort(F.collect_list("n_name")), ";").alias("names"))


@query("SELECT p_brand, min(p_name) AS sample_name FROM part GROUP BY p_brand")
def agg_sample(spark: SparkSession, d: str) -> DataFrame:
    """One name of each group; the smallest, so that runs agree."""
    return table(spark, d, "part").groupBy("p_brand").agg(F.min("p_name").alias("sample_name"))


@query("SELECT user_id, event_id, event_type, value FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1")
def dedupe_last_wins(spark: SparkSession, d: str) -> DataFrame:
    return last_wins(table(spark, d, "events"), ["user_id"], ["ts", "event_id"]).select("user_id", "event_id", "event_type", "value")


@query("SELECT event_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id)::INTEGER AS n, rank() OVER (PARTITION BY user_id ORDER BY event_type)::INTEGER AS type_rank FROM events")
def row_number(spark: SparkSession, d: str) -> DataFrame:
    w = Window.partitionBy("user_id")
    return table(spark, d, "events").select("event_id", F.row_number().over(w.orderBy("ts", "event_id")).alias("n"), F.rank().over(w.orderBy("event_type")).alias("type_rank"))


@query("SELECT event_id, lag(event_type) OVER w AS previous_type, lead(event_id) OVER w AS next_id FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)")
def lag_lead(spark: SparkSession, d: str) -> DataFrame:
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    return table(spark, d, "events").select("event_id", F.lag("event_type").over(w).alias("previous_type"), F.lead("event_id").over(w).alias("next_id"))


@query("SELECT event_id, count(*) OVER w AS n_recent, max(value) OVER w AS max_recent FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 3 PRECEDING AND CURRENT ROW)")
def frame_sum(spark: SparkSession, d: str) -> DataFrame:
    w = Window.partitionBy("user_id").orderBy("ts", "event_id").rowsBetween(-3, 0)
    return table(spark, d, "events").select("event_id", F.count("*").over(w).alias("n_recent"), F.max("value").over(w).alias("max_recent"))


@query("""SELECT user_id, count(*) FILTER (event_type = 'click') AS click, count(*) FILTER (event_type = 'error') AS error, count(*) FILTER (event_type = 'purchase') AS purchase,
count(*) FILTER (event_type = 'signup') AS signup, count(*) FILTER (event_type = 'view') AS view FROM events GROUP BY user_id""")
def pivot_values(spark: SparkSession, d: str) -> DataFrame:
    kinds = ["click", "error", "purchase", "signup", "view"]
    return table(spark, d, "events").groupBy("user_id").pivot("event_type", kinds).count().na.fill(0, kinds)


@query("""SELECT a.event_id, b.value FROM (SELECT * FROM events WHERE event_type = 'purchase') a
ASOF LEFT JOIN (SELECT user_id, ts, max(value) AS value FROM events WHERE event_type = 'view' GROUP BY user_id, ts) b ON a.user_id = b.user_id AND a.ts >= b.ts""")
def join_as_of(spark: SparkSession, d: str) -> DataFrame:
    """The last view's value before each purchase."""
    e = table(spark, d, "events")
    return as_of(e.filter("event_type = 'purchase'").select("event_id", "user_id", "ts"), e.filter("event_type = 'view'"), "user_id", "ts", "ts", "value").select("event_id", "value")


@query("""SELECT coalesce(b.k, a.k) AS k, coalesce(b.size, a.size) AS size, coalesce(b.price, a.price) AS price FROM
(SELECT p_partkey AS k, p_size AS size, p_retailprice AS price FROM part WHERE p_partkey % 3 <> 0) a FULL JOIN
(SELECT p_partkey AS k, nullif(p_size, 10) AS size, NULL::DOUBLE AS price FROM part WHERE p_partkey % 2 = 0) b ON a.k = b.k""")
def sheet_upsert(spark: SparkSession, d: str) -> DataFrame:
    """A sheet's cells renewed by key; nulls leave the old cell."""
    p = table(spark, d, "part").select(F.col("p_partkey").alias("k"), F.col("p_size").alias("size"), F.col("p_retailprice").alias("price"))
    new = p.filter("k % 2 = 0").select("k", F.nullif("size", F.lit(10)).alias("size"), F.lit(None).cast("double").alias("price"))
    return upsert(p.filter("k % 3 <> 0"), new, ["k"])
