"""Queries: nested documents of orders with their lines, against JSON Schemas."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import schemas as S
from ..sources.tables import table
from .registry import query
from .validation import RULES

_LINE = {
    "type": "object",
    "required": ["quantity", "note"],
    "additionalProperties": False,
    "properties": {
        "n": {"type": "integer", "minimum": 1},
        "quantity": {"type": "number", "maximum": 48},
        "flag": {"oneOf": [{"enum": ["A", "R"]}, {"pattern": "^[RN]$"}]},
        "note": {"anyOf": [{"type": "null"}, {"type": "string", "minLength": 4}]},
    },
}
ORDER = {
    "type": "object",
    "required": ["key", "lines"],
    "definitions": {"line": _LINE},
    "properties": {
        "key": {"type": "integer"},
        "status": {"const": "F"},
        "price": {"type": "number", "not": {"minimum": 450000}},
        "lines": {"type": "array", "minItems": 2, "items": {"$ref": "#/definitions/line"}},
    },
}


def order_documents(spark: SparkSession, d: str) -> DataFrame:
    """o_orderkey, document: an order with its lines; those without lines have no such key, some lines have a key too much, others lack one."""
    line = table(spark, d, "lineitem")
    note = F.when(F.col("l_partkey") % 3 == 1, F.lit("a note")).when(F.col("l_partkey") % 3 == 2, F.lit("n/a"))
    one = F.struct("l_linenumber", "l_partkey", "l_quantity", "l_returnflag", note.alias("note"))
    lines = line.groupBy("l_orderkey").agg(F.array_sort(F.collect_list(one)).alias("lines"))

    def text(x):
        body = F.to_json(F.struct(x["l_linenumber"].alias("n"), x["l_quantity"].alias("quantity"), x["l_returnflag"].alias("flag")))
        more = F.when(x["l_partkey"] % 50 == 0, "").otherwise(F.concat(F.lit(',"note":'), F.coalesce(F.concat(F.lit('"'), x["note"], F.lit('"')), F.lit("null"))))
        extra = F.when(x["l_partkey"] % 49 == 0, ',"extra":1').otherwise("")
        return F.concat(F.left(body, F.char_length(body) - 1), more, extra, F.lit("}"))

    head = F.to_json(F.struct(F.col("o_orderkey").alias("key"), F.col("o_orderstatus").alias("status"), F.col("o_totalprice").alias("price")))
    tail = F.coalesce(F.concat(F.lit(',"lines":['), F.array_join(F.transform("lines", text), ","), F.lit("]")), F.lit(""))
    joined = table(spark, d, "orders").join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    return joined.select("o_orderkey", F.parse_json(F.concat(F.left(head, F.char_length(head) - 1), tail, F.lit("}"))).alias("document"))


_SQL = """
l AS (SELECT l_orderkey AS k, l_partkey AS p, l_quantity AS q, l_returnflag AS f, '#/lines/' || (row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_quantity, l_returnflag) - 1) AS place FROM lineitem),
v AS (SELECT o_orderkey AS k, '#' AS pointer, 'required' AS keyword FROM orders WHERE o_orderkey NOT IN (SELECT k FROM l)
UNION ALL SELECT o_orderkey, '#/status', 'const' FROM orders WHERE o_orderstatus <> 'F'
UNION ALL SELECT o_orderkey, '#/price', 'not' FROM orders WHERE o_totalprice >= 450000
UNION ALL SELECT k, '#/lines', 'minItems' FROM l JOIN orders ON k = o_orderkey GROUP BY k HAVING count(*) < 2
UNION ALL SELECT k, place, 'required' FROM l WHERE p % 50 = 0
UNION ALL SELECT k, place, 'additionalProperties' FROM l WHERE p % 49 = 0
UNION ALL SELECT k, place || '/quantity', 'maximum' FROM l WHERE q > 48
UNION ALL SELECT k, place || '/flag', 'oneOf' FROM l WHERE f = 'R'
UNION ALL SELECT k, place || '/note', 'anyOf' FROM l WHERE p % 3 = 2 AND p % 50 <> 0)"""


@query(f"WITH {_SQL} SELECT k AS o_orderkey, pointer, keyword FROM v JOIN orders ON k = o_orderkey")
def schema_violations(spark: SparkSession, d: str) -> DataFrame:
    found = S.schema_violations(order_documents(spark, d), ["o_orderkey"], F.col("document"), ORDER)
    return found.select("o_orderkey", "pointer", "keyword")


@query(f"WITH {_SQL} SELECT o_orderkey, o_orderkey NOT IN (SELECT k FROM v) AS ok FROM orders")
def schema_valid(spark: SparkSession, d: str) -> DataFrame:
    return order_documents(spark, d).select("o_orderkey", S.valid(ORDER, F.col("document")).alias("ok"))


@query(
    "SELECT o_orderkey, pointer, keyword FROM orders, LATERAL (SELECT * FROM (VALUES ('#/o_totalprice', 'maximum', o_totalprice > 400000), ('#/o_orderpriority', 'enum', o_orderpriority NOT IN ('1-URGENT', '2-HIGH', '3-MEDIUM')),"
    " ('#/o_orderstatus', 'pattern', o_orderstatus NOT IN ('O', 'F')), ('#/o_orderstatus', 'pattern', o_orderstatus NOT IN ('O', 'F'))) t(pointer, keyword, bad) WHERE bad)"
)
def schema_from_rules(spark: SparkSession, d: str) -> DataFrame:
    """Rules exported as a JSON Schema, read back, and applied."""
    schema = json.loads(S.schema_text(S.schema_of([r for r in RULES if r.when is None]), "orders"))
    rows = table(spark, d, "orders").select("o_orderkey", F.to_variant_object(F.struct("o_totalprice", "o_orderpriority", "o_orderstatus")).alias("document"))
    return S.schema_violations(rows, ["o_orderkey"], F.col("document"), schema).select("o_orderkey", "pointer", "keyword")
