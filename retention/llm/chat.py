"""Chat formatting of reply trees.

A message names the message it replies to. Root-to-leaf paths are enumerated with self-joins that
double their reach: the table of 2^k-th ancestors joined with itself gives that of 2^(k+1)-th
ones, so a tree of depth d takes log2(d) joins, none of which grows a row. The same tables sum the
scores along each path; the leaves of a tree are ranked by their path's mean score, and the best
paths are read out by following the tables down from each chosen leaf.

A turn is written ``### role: text</turn>`` and a line break. Inside texts and roles a backslash is
written ``\\b``, ``#`` as ``\\h``, ``</turn>`` as ``\\l/turn>`` (and ``:`` in roles as ``\\c``), so the
template's marks occur nowhere else and reading back is exact. The loss mask is a list of
(start, length) in code points, one for each assistant text.

Defined cases: null text or role: empty; rows of equal tree and message ids: one message, the
smallest; a parent that isn't there: the message is a root; replies in a circle: an error; null tree
ids are one tree; null scores count as 0; of equal mean scores the longer path, then the smaller
leaf id goes first; empty table: no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from retention.session import materialize

TURN_END = "</turn>\n"
#: Parts of a tree's leaves that are ranked apart before the best of them are ranked together.
SALTS = 64


def escaped(text: Column) -> Column:
    for plain, coded in (("\\", "\\b"), ("#", "\\h"), ("</turn>", "\\l/turn>")):
        text = F.replace(text, F.lit(plain), F.lit(coded))
    return text


def unescaped(text: Column) -> Column:
    for plain, coded in (("<", "\\l"), ("#", "\\h"), (":", "\\c"), ("\\", "\\b")):
        text = F.replace(text, F.lit(coded), F.lit(plain))
    return text


def reply_trees(conversations: DataFrame) -> DataFrame:
    """Linear conversations (conv_id, turn, role, text) as trees in which each row replies to the one
    before it, by turn, then role and text."""
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    rows = conversations.select("conv_id", "role", "text", F.row_number().over(order).cast("bigint").alias("message_id"))
    parent = F.when(F.col("message_id") > 1, F.col("message_id") - 1)
    return rows.select(F.col("conv_id").alias("tree_id"), "message_id", parent.alias("parent_id"), "role", "text", F.lit(0.0).alias("score"))


def _messages(trees: DataFrame) -> DataFrame:
    """(t, id, parent, body): one row per message; t is a key of the tree that is never null."""
    t = F.when(F.col("tree_id").isNull(), F.lit("-")).otherwise(F.concat(F.lit("="), F.col("tree_id").cast("string")))
    body = F.struct(F.col("parent_id").alias("parent"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"), F.coalesce(F.col("score").cast("double"), F.lit(0.0)).alias("score"), "tree_id")
    rows = trees.where(F.col("message_id").isNotNull()).select(t.alias("t"), F.col("message_id").alias("id"), body.alias("body"))
    return rows.groupBy("t", "id").agg(F.min("body").alias("body"))


def best_paths(trees: DataFrame, keep: int = 1) -> DataFrame:
    """(tree_id, path_rank, leaf_id, position, role, text): the messages of each tree's ``keep`` best
    root-to-leaf paths, position 0 at the leaf and falling towards the root."""
    messages = materialize(_messages(trees))
    ids = messages.select("t", "id")
    wanted = messages.select("t", "id", F.col("body.parent").alias("up"), F.col("body.score").alias("total"), F.lit(1).cast("bigint").alias("depth"))
    there = ids.withColumnRenamed("id", "up").withColumn("_there", F.lit(True))
    hop = wanted.join(there, ["t", "up"], "left").select("t", "id", F.when(F.col("_there"), F.col("up")).alias("up"), "total", "depth")
    hop = materialize(hop)
    hops, open_before = [], None
    while True:
        open_now = hop.where("up is not null").count()
        if not open_now:
            break
        if open_now == open_before:
            raise ValueError("messages reply to each other in a circle")
        open_before = open_now
        hops.append(hop.where("up is not null").select("t", "id", "up"))
        far = hop.select("t", F.col("id").alias("up"), F.col("up").alias("_up"), F.col("total").alias("_total"), F.col("depth").alias("_depth"))
        done = hop.where("up is null").select("t", "id", "up", "total", "depth")
        more = hop.where("up is not null").join(far, ["t", "up"]).select("t", "id", F.col("_up").alias("up"), (F.col("total") + F.col("_total")).alias("total"), (F.col("depth") + F.col("_depth")).alias("depth"))
        hop = materialize(done.unionByName(more))
    # without a parent that is there, a message is a root, so only true replies make a message inner
    replied = (hops[0].select("t", F.col("up").alias("id")) if hops else ids.limit(0)).distinct()
    leaves = hop.join(replied, ["t", "id"], "left_anti").withColumn("mean", F.col("total") / F.col("depth"))
    best = [F.desc("mean"), F.desc("depth"), F.asc("id")]
    some = leaves.withColumn("_salt", F.pmod(F.xxhash64("id"), F.lit(SALTS)))
    some = some.withColumn("_r", F.row_number().over(Window.partitionBy("t", "_salt").orderBy(*best))).where(F.col("_r") <= keep)
    chosen = some.withColumn("path_rank", F.row_number().over(Window.partitionBy("t").orderBy(*best))).where(F.col("path_rank") <= keep)
    paths = materialize(chosen.select("t", "path_rank", F.col("id").alias("leaf_id"), "id", F.lit(0).cast("bigint").alias("position")))
    for k, step in enumerate(hops):
        # paths reach 2^k messages by now: their 2^k-th ancestors are the next 2^k
        ahead = paths.join(step, ["t", "id"]).select("t", "path_rank", "leaf_id", F.col("up").alias("id"), (F.col("position") - (1 << k)).alias("position"))
        paths = materialize(paths.unionByName(ahead))
    return paths.join(messages, ["t", "id"]).select("t", F.col("body.tree_id").alias("tree_id"), "path_rank", "leaf_id", "position", F.col("body.role").alias("role"), F.col("body.text").alias("text"))


def format_paths(paths: DataFrame, learn: str = "assistant") -> DataFrame:
    """(tree_id, path_rank, leaf_id, formatted, loss_mask): each path as one conversation. The loss mask
    covers the texts of the role ``learn``."""
    role = F.replace(escaped(F.col("role")), F.lit(":"), F.lit("\\c"))
    head = F.concat(F.lit("### "), role, F.lit(": "))
    turns = paths.withColumn("_head", head).withColumn("_body", escaped(F.col("text")))
    turns = turns.withColumn("_turn", F.concat("_head", "_body", F.lit(TURN_END)))
    before = Window.partitionBy("t", "path_rank", "leaf_id").orderBy("position").rowsBetween(Window.unboundedPreceding, -1)
    at = F.coalesce(F.sum(F.length("_turn").cast("bigint")).over(before), F.lit(0)) + F.length("_head")
    turns = turns.withColumn("_at", at)
    turn = F.struct("position", F.col("_turn").alias("turn"), F.struct(F.col("_at").cast("bigint").alias("start"), F.length("_body").cast("bigint").alias("length")).alias("span"), (F.col("role") == learn).alias("learnt"))
    made = turns.groupBy("t", "path_rank", "leaf_id").agg(F.first("tree_id").alias("tree_id"), F.sort_array(F.collect_list(turn)).alias("_turns"))
    mask = F.transform(F.filter("_turns", lambda x: x.learnt), lambda x: x.span)
    return made.select("tree_id", "path_rank", "leaf_id", F.array_join(F.transform("_turns", lambda x: x.turn), "").alias("formatted"), mask.alias("loss_mask"))


def read_back(formatted: DataFrame) -> DataFrame:
    """Adds turns (array of role and text) and loss_texts, both read from the formatted text and mask."""
    cut = F.split("formatted", TURN_END)
    bodies = F.slice(cut, 1, F.greatest(F.size(cut) - 1, F.lit(0)))

    def turn(x: Column) -> Column:
        colon = F.locate(": ", x)
        return F.struct(unescaped(F.substring(x, F.lit(5), colon - 5)).alias("role"), unescaped(F.substring(x, colon + 2, F.length(x))).alias("text"))

    whole = F.col("formatted")
    loss = F.transform("loss_mask", lambda s: unescaped(F.substring(whole, (s.start + 1).cast("int"), s.length.cast("int"))))
    return formatted.withColumns({"turns": F.transform(bodies, turn), "loss_texts": loss})


def chat_digests(conversations: DataFrame) -> DataFrame:
    """Formats every conversation and returns digests of what reads back from the output."""
    back = read_back(format_paths(best_paths(reply_trees(conversations))))
    loss = F.array_join("loss_texts", "")
    said = F.array_join(F.transform("turns", lambda x: F.concat(x.role, F.lit("\n"), x.text, F.lit("\n"))), "")
    return back.select(
        F.col("tree_id").alias("conv_id"), F.size("turns").cast("bigint").alias("n_turns"), F.sha2(said.cast("binary"), 256).alias("turns_sha256"),
        F.length(loss).cast("bigint").alias("loss_chars"), F.sha2(loss.cast("binary"), 256).alias("loss_sha256"), F.length("formatted").cast("bigint").alias("formatted_chars"),
    )


#: The same digests from the rows themselves.
ORACLE_SQL = r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '\### Assistant: </turn> ok'), (-7, 1, 'assistant', '\### Assistant: </turn> ok')
), e AS (
  SELECT *, length(replace(replace(replace(text, '\', '\b'), '#', '\h'), '</turn>', '\l/turn>')) AS text_chars,
    length(replace(replace(replace(replace(role, '\', '\b'), '#', '\h'), '</turn>', '\l/turn>'), ':', '\c')) AS role_chars FROM c
)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(CASE WHEN role = 'assistant' THEN length(text) END), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text ELSE '' END, '' ORDER BY turn, role, text), '')) AS loss_sha256,
  CAST(sum(4 + role_chars + 2 + text_chars + 8) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id
"""
