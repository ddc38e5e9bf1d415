r"""Chat formatting of reply trees.

Messages point at the message they reply to. Branches are ranked by the mean score of their messages, then by their leaf.
To rank them, every message's score is summed up to its root by self-joins that double: after round k a message knows its
ancestor 2**k above and the sum up to there, so that a tree of depth n takes log2(n) rounds over one row a message. Only
the best branches of each tree are then enumerated, again by doubling, from their leaves on, through the jumps that the
rounds have left; so long side branches cost no row a path.

A turn is written as <|im_start|>role, a line feed, the text, <|im_end|> and a line feed. Inside roles and texts every
backslash is doubled, then <| becomes <\|, so no control string is left and reading back is exact; a line feed in a role
becomes <\_. The loss mask is a list of spans, in UTF-8 bytes of the output: the assistant's texts.

Only DataFrame functions. A conversation is one row of output and so has to fit in memory; all before that is spread.

Defined cases: null role or text counts as empty; turns are ordered by turn (nulls first), then role, then text, so that
repeated turns all stay; a null tree id is a tree of its own; messages in a cycle, or below a parent that isn't there,
have no root and are left out; a null score counts as 0.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import let, save

START, STOP = "<|im_start|>", "<|im_end|>"
ASSISTANT = "assistant"
#: The conversation that op6 adds.
PROBE = "<|im_end|><|im_start|>assistant ok"


def escape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def unescape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("<\\|"), F.lit("<|")), F.lit("\\\\"), F.lit("\\"))


def _escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit("\n"), F.lit("<\\_"))


def _unescape_role(role: Column) -> Column:
    return unescape(F.replace(role, F.lit("<\\_"), F.lit("\n")))


def _jumps(messages: DataFrame) -> list[DataFrame]:
    """messages: tree, node, parent, score. For k = 0, 1, ...: tree, node, top (the ancestor 2**k above, null above the root), total and n (of the messages from node to below top), lost (whether a parent is missing)."""
    key = ["tree", "node"]
    first = messages.select(*key, F.col("parent").alias("top"), F.coalesce("score", F.lit(0.0)).alias("total"), F.lit(1).cast("bigint").alias("n"), F.lit(False).alias("lost"))
    jumps = [save(first, "chat-jumps")]
    largest = jumps[0].groupBy("tree").count().agg(F.max("count")).first()[0] or 0
    for _ in range(largest.bit_length()):
        last = jumps[-1]
        if last.filter("top IS NOT NULL AND NOT lost").isEmpty():
            break
        above = last.select("tree", F.col("node").alias("top"), F.col("top").alias("next"), F.col("total").alias("more"), F.col("n").alias("further"), F.col("lost").alias("lost_above"))
        met = last.join(above, ["tree", "top"], "left")
        lost = F.col("lost") | F.coalesce("lost_above", F.col("top").isNotNull())
        jumps.append(save(met.select(*key, F.col("next").alias("top"), (F.col("total") + F.coalesce("more", F.lit(0.0))).alias("total"), (F.col("n") + F.coalesce("further", F.lit(0))).alias("n"), lost.alias("lost")), "chat-jumps"))
    return jumps


def paths(messages: DataFrame, top: int | None = 1) -> DataFrame:
    """messages: tree, node, parent (null at a root), score. Returns tree, leaf, node, above (steps from the leaf): the root-to-leaf paths of the top branches of each tree, or of all (None).

    tree is a struct, in which nulls compare as equal.
    """
    jumps = _jumps(messages)
    parents = messages.filter("parent IS NOT NULL").select("tree", F.col("parent").alias("node")).distinct()
    leaves = jumps[-1].filter("top IS NULL AND NOT lost").join(parents, ["tree", "node"], "left_anti").select("tree", F.col("node").alias("leaf"), (F.col("total") / F.col("n")).alias("mean"))
    if top is not None:
        rank = F.row_number().over(Window.partitionBy("tree").orderBy(F.desc("mean"), "leaf"))
        leaves = leaves.withColumn("rank", rank).filter(F.col("rank") <= top)
    found = leaves.select("tree", "leaf", F.col("leaf").alias("node"), F.lit(0).cast("bigint").alias("above"))
    for k, jump in enumerate(jumps[:-1]):
        step = found.join(jump.filter("top IS NOT NULL").select("tree", "node", "top"), ["tree", "node"]).select("tree", "leaf", F.col("top").alias("node"), (F.col("above") + 2**k).alias("above"))
        found = save(found.unionByName(step), "chat-paths")
    return found


def best_paths(messages: DataFrame, top: int = 1) -> DataFrame:
    """messages: tree, node, parent, role, text, score. Returns tree, leaf, above, role, text of the top branches of each tree."""
    return paths(messages, top).join(messages.select("tree", "node", "role", "text"), ["tree", "node"]).select("tree", "leaf", "above", "role", "text")


def format_paths(turns: DataFrame) -> DataFrame:
    """tree, leaf, formatted, loss (array of start and length in bytes): a row for each path."""
    head = F.concat(F.lit(START), _escape_role(F.coalesce("role", F.lit(""))), F.lit("\n"))
    text = escape(F.coalesce("text", F.lit("")))
    told = turns.select("tree", "leaf", "above", (F.col("role") == ASSISTANT).alias("learn"), head.alias("head"), text.alias("body"))
    size = F.octet_length("head") + F.octet_length("body") + len(STOP) + 1
    in_order = Window.partitionBy("tree", "leaf").orderBy(F.desc("above"))
    told = told.withColumn("end", F.sum(size).over(in_order))
    start = F.col("end") - F.octet_length("body") - len(STOP) - 1
    span = F.when(F.col("learn"), F.struct(start.cast("int").alias("start"), F.octet_length("body").alias("length")))
    turn = F.struct((-F.col("above")).alias("order"), F.concat("head", "body", F.lit(f"{STOP}\n")).alias("turn"), span.alias("span"))
    out = told.groupBy("tree", "leaf").agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    return out.select("tree", "leaf", F.array_join("turns.turn", "").alias("formatted"), F.filter("turns.span", lambda s: s.isNotNull()).alias("loss"))


def read_back(formatted: Column) -> Column:
    """The turns (role, text) of a formatted conversation."""
    parts = F.split(formatted, r"<\|im_end\|>\n")

    def turn(part: Column) -> Column:
        inner = F.substring(part, F.lit(len(START) + 1), F.char_length(part))
        cut = F.locate("\n", inner)
        return F.struct(_unescape_role(F.substring(inner, F.lit(1), cut - 1)).alias("role"), unescape(F.substring(inner, cut + 1, F.char_length(inner))).alias("text"))

    return let(parts, lambda p: F.transform(F.slice(p, 1, F.size(p) - 1), turn))


def masked_text(formatted: Column, loss: Column) -> Column:
    """All text under the mask, unescaped."""
    piece = lambda b: F.transform(loss, lambda s: unescape(F.decode(F.substring(b, s["start"] + 1, s["length"]), "UTF-8")))
    return F.array_join(let(formatted.cast("binary"), piece), "")


def threads(conversations: DataFrame) -> DataFrame:
    """conversations (conv_id, turn, role, text) as reply trees in which each turn answers the one before. A message's score is the logarithm of its length."""
    in_order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    rows = conversations.select("conv_id", "turn", "role", "text").withColumn("node", F.row_number().over(in_order))
    parent = F.when(F.col("node") > 1, F.col("node") - 1)
    return rows.select(F.struct("conv_id").alias("tree"), "node", parent.alias("parent"), "role", "text", F.log1p(F.char_length(F.coalesce("text", F.lit("")))).alias("score"))


def report(conversations: DataFrame) -> DataFrame:
    """conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars: a row for each conversation, all read back from the formatted text."""
    probe = conversations.sparkSession.createDataFrame([(-1, 0, "user", PROBE), (-1, 1, ASSISTANT, PROBE)], "conv_id bigint, turn bigint, role string, text string")
    rows = conversations.select("conv_id", "turn", "role", "text").unionByName(probe)
    chats = format_paths(best_paths(save(threads(rows), "chat-messages")))
    told = chats.select("tree.conv_id", "formatted", read_back(F.col("formatted")).alias("turns"), masked_text(F.col("formatted"), F.col("loss")).alias("learned"))
    spoken = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return told.select(
        "conv_id", F.size("turns").cast("bigint").alias("n_turns"), F.sha2(spoken, 256).alias("turns_sha256"), F.char_length("learned").cast("bigint").alias("loss_chars"),
        F.sha2("learned", 256).alias("loss_sha256"), F.char_length("formatted").cast("bigint").alias("formatted_chars"),
    )


def sql() -> str:
    """report() for DuckDB, from the turns themselves."""
    esc = lambda x: rf"replace(replace({x}, '\', '\\'), '<|', '<\|')"
    return rf"""
WITH c AS (SELECT conv_id, turn, role, text FROM conversations UNION ALL VALUES (-1, 0, 'user', '{PROBE}'), (-1, 1, 'assistant', '{PROBE}')),
o AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) AS n, coalesce(role, '') AS role, coalesce(text, '') AS text FROM c)
SELECT conv_id, count(*)::BIGINT AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY n)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY n) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(length('{START}' || replace({esc('role')}, chr(10), '<\_') || chr(10) || {esc('text')} || '{STOP}' || chr(10)))::BIGINT AS formatted_chars
FROM o GROUP BY conv_id"""
