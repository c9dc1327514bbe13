"""Prefix trie of conversations: which beginnings are shared, by how many, and what sharing saves.

1. Turns (role, text) are numbered by a dictionary of their digests; a conversation is an array of
   numbers. Equal conversations become one row with their count and smallest id.
2. The arrays are dealt by ranges of their order, so that a shard is a run of neighbours, and each
   shard builds a ternary search tree (``ternary_trie``).
3. Only prefixes of a shard's first and last array can go on in other shards. All others are whole
   and leave their shard as results. The shared ones are named by a digest of their path and merged
   by an aggregate; a node's own share of leaves and savings is added to its prefixes by running
   sums along each shard's first and last path, where a node counts in one path only.

The rows of step 3 are two paths a shard, so they grow with shards times turns of a conversation. A
conversation is held whole in one row and so bounds a task's memory. A prefix or a conversation that
most share is spread over shards by its continuations, or is one row.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from retention.llm.ternary_trie import ROOT_KEY, TernaryTree, next_key
from retention.session import materialize, ship_package

#: Conversations whose first one lends its beginning, and the most turns it lends.
FAMILY, MOST_LENT = 100, 5
#: Turns in a shard, about.
SHARD_TURNS = 100_000
OUT_ROWS = 20_000
NO_ENDS = ROOT_KEY.hex()  # the digest of nothing

ENDS = "key binary, ends string"
NODES = ("conv_id bigint, depth bigint, parent_conv_id bigint, n_convs bigint, n_children bigint, n_leaves bigint, "
         "saved_tokens bigint, ends string, parent_key binary, key binary, path bigint, chars bigint")
OUT = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def turn_rows(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, digest, chars); the digest names role and text."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    name = F.concat(F.length(role).cast("string"), F.lit(":"), role, text)
    return conversations.where("conv_id is not null").select(
        "conv_id", "turn", role.alias("role"), F.unhex(F.sha2(name.cast("binary"), 256)).alias("digest"), F.length(text).cast("bigint").alias("chars"))


def sequences(conversations: DataFrame) -> DataFrame:
    """(conv_id, ids, chars): each conversation's turns in order, as dictionary numbers and lengths in code
    points. Turns of equal number stand by role, then digest."""
    rows = materialize(turn_rows(conversations))
    numbers = materialize(rows.groupBy("digest").agg(F.lit(1).alias("_one")).select("digest", F.monotonically_increasing_id().alias("id")))
    turns = rows.join(numbers, "digest").groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "role", "digest", "id", "chars"))).alias("t"))
    return turns.select("conv_id", F.col("t.id").alias("ids"), F.col("t.chars").alias("chars"))


def rebuilt(own: DataFrame) -> DataFrame:
    """``sequences`` whose first h turns are those of the family's first conversation (all if it has fewer,
    none if there is none), followed by their own after their first h; h is crc32 of the id, modulo 6."""
    own = materialize(own)
    lender = own.where(F.col("conv_id") % FAMILY == 0).select(
        F.col("conv_id").alias("_base"), F.slice("ids", 1, MOST_LENT).alias("_ids"), F.slice("chars", 1, MOST_LENT).alias("_chars"))
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % (MOST_LENT + 1)).cast("int")
    both = own.withColumn("_base", F.col("conv_id") - F.col("conv_id") % FAMILY).withColumn("_h", h).join(lender, "_base", "left")

    def joined(column):
        lent = F.coalesce(F.slice(f"_{column}", F.lit(1), F.col("_h")), F.array().cast("array<bigint>"))
        return F.concat(lent, F.slice(column, F.col("_h") + 1, F.size(column))).alias(column)

    return both.select("conv_id", joined("ids"), joined("chars"))


def _digest_ends(fields):
    """Digests of the ids of each key, for rows sorted by key and id; holds one digest at a time."""

    def run(batches):
        import hashlib

        from pyspark.sql.pandas.types import to_arrow_schema

        schema = to_arrow_schema(fields)
        key, digest, out = None, None, []
        for b in batches:
            for k, conv in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if k != key:
                    if digest:
                        out.append((key, digest.hexdigest()))
                    key, digest = k, hashlib.sha256(b"%d" % conv)
                else:
                    digest.update(b",%d" % conv)
            if len(out) > OUT_ROWS:
                yield _batch(out, schema)
                out = []
        if digest:
            yield _batch([*out, (key, digest.hexdigest())], schema)

    return run


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def distinct_sequences(convs: DataFrame) -> DataFrame:
    """(ids, chars, members, least, ends): a row for each different sequence, the digest of its members' ids
    in ascending order among it."""
    fields = convs.sparkSession.createDataFrame([], ENDS).schema
    keyed = convs.withColumn("key", F.unhex(F.sha2(F.array_join("ids", ",").cast("binary"), 256)))
    ends = keyed.select("key", "conv_id").repartition("key").sortWithinPartitions("key", "conv_id").mapInArrow(_digest_ends(fields), fields)
    return keyed.groupBy("key", "ids", "chars").agg(F.count("*").alias("members"), F.min("conv_id").alias("least")).join(ends, "key").drop("key")


def _shard_nodes(fields):
    """A shard's nodes: whole ones as results, those on its first and last path as parts."""

    def run(batches):
        from pyspark import TaskContext
        from pyspark.sql.pandas.types import to_arrow_schema

        schema = to_arrow_schema(fields)
        rows = []
        for b in batches:
            rows += zip(*(b.column(i).to_pylist() for i in range(5)))
        if not rows:
            return
        tree = TernaryTree()
        at = tree.insert_sorted(rows)
        paths = [tree.path(at[0])] + ([tree.path(at[-1])] if len(rows) > 1 else [])
        parts = {n for p in paths for n in p}
        children, leaves, saved = tree.accumulate(parts)
        keys, out = {0: ROOT_KEY}, []
        for side, path in enumerate(paths):
            name = 2 * TaskContext.get().partitionId() + side
            for node in path:
                up = tree.parent[node]
                new = node not in keys or side == 0 and node == 0
                if node not in keys:
                    keys[node] = next_key(keys[up], tree.turn[node])
                sums = (tree.members[node], children[node], leaves[node], saved[node]) if new else (0, 0, 0, 0)
                out.append((tree.least[node], tree.depth[node], None, *sums, tree.ends[node], keys[up] if node else None, keys[node], name, tree.chars[node]))
        for node in range(len(tree.turn)):
            if node not in parts:
                up = tree.parent[node]
                least, key = (None, keys[up]) if up in parts else (tree.least[up], None)
                out.append((tree.least[node], tree.depth[node], least, tree.members[node], children[node], leaves[node], saved[node], tree.ends[node], key, None, None, None))
            if len(out) >= OUT_ROWS:
                yield _batch(out, schema)
                out = []
        if out:
            yield _batch(out, schema)

    return run


def merged(parts: DataFrame) -> DataFrame:
    """The nodes that shards share, whole: (key, parent_key and the results' columns)."""
    nodes = materialize(parts.groupBy("key").agg(
        F.min("conv_id").alias("conv_id"), F.max("depth").alias("depth"), F.max("parent_key").alias("parent_key"), F.sum("n_convs").alias("n_convs"),
        F.sum("n_children").alias("n_children"), F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved_tokens"),
        F.max("ends").alias("ends"), F.max("chars").alias("chars"), F.min("path").alias("_home")))
    below = nodes.groupBy(F.col("parent_key").alias("key")).agg(F.count("*").alias("_below"))
    nodes = nodes.join(below, "key", "left").withColumn("n_children", F.col("n_children") + F.coalesce("_below", F.lit(0))).drop("_below")
    own = nodes.select("key", "_home", F.when(F.col("n_children") == 0, 1).otherwise(0).alias("_leaf"), ((F.col("n_convs") - 1) * F.col("chars")).alias("_own"))
    onward = Window.partitionBy("path").orderBy(F.col("depth").desc()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    here = F.col("path") == F.col("_home")
    sums = parts.select("key", "path", "depth").join(own, "key").select(
        "key", F.sum(F.when(here, F.col("_leaf")).otherwise(0)).over(onward).alias("_leaf"), F.sum(F.when(here, F.col("_own")).otherwise(0)).over(onward).alias("_own"))
    sums = sums.groupBy("key").agg(F.sum("_leaf").alias("_leaf"), F.sum("_own").alias("_own"))
    whole = nodes.join(sums, "key").withColumn("n_leaves", F.col("n_leaves") + F.col("_leaf")).withColumn("saved_tokens", F.col("saved_tokens") + F.col("_own"))
    return materialize(whole.drop("_leaf", "_own", "_home", "chars"))


def trie_nodes(convs: DataFrame) -> DataFrame:
    """A row for each distinct prefix of ``convs`` (conv_id, ids, chars), the empty one included.

    Empty input has no nodes, not even a root."""
    spark = convs.sparkSession
    ship_package(spark)
    fields = spark.createDataFrame([], NODES).schema
    different = materialize(distinct_sequences(materialize(convs)))
    turns = different.agg(F.sum(F.size("ids") + 1)).first()[0] or 0
    dealt = different.repartitionByRange(turns // SHARD_TURNS + 1, "ids").sortWithinPartitions("ids")
    found = materialize(dealt.mapInArrow(_shard_nodes(fields), fields))
    shared = merged(found.where("key is not null"))
    whole = found.where("key is null")
    least = shared.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("_least"))
    below = whole.where("parent_key is not null").join(least, "parent_key").withColumn("parent_conv_id", F.col("_least"))
    top = shared.join(least, "parent_key", "left").withColumn("parent_conv_id", F.col("_least"))
    ends = F.coalesce("ends", F.lit(NO_ENDS)).alias("ends_sha256")
    return (whole.where("parent_key is null").select(*OUT[:-1], ends)
            .unionByName(below.select(*OUT[:-1], ends)).unionByName(top.select(*OUT[:-1], ends)))


def conversation_trie(conversations: DataFrame) -> DataFrame:
    """The trie of all rebuilt conversations.

    Defined cases: null role or text: empty; null turn: first; equal turns: by role, then digest, so
    repeated rows are turns of their own; null conv_id: belongs to no conversation and is left out;
    negative ids: the remainder has the id's sign; a conversation of very many turns or very long texts:
    one array of numbers, whole; empty table: no rows; other columns aren't read.
    """
    return trie_nodes(rebuilt(sequences(conversations)))


ORACLE_SQL = f"""
WITH crc AS (
  SELECT list(c ORDER BY i) AS tab
  FROM (SELECT i, list_reduce(list_prepend(i, range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(3988292384::BIGINT, c >> 1) ELSE c >> 1 END) AS c FROM range(256) t(i))),
t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS k,
         length(coalesce(text, ''))::BIGINT AS chars
  FROM conversations WHERE conv_id IS NOT NULL),
o AS (SELECT conv_id, list(k ORDER BY turn NULLS FIRST, role, k) AS ks, list(chars ORDER BY turn NULLS FIRST, role, k) AS cs FROM t GROUP BY conv_id),
h AS (
  SELECT o.*, conv_id - conv_id % {FAMILY} AS base,
         xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(conv_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
                         lambda c, b: xor(c >> 8, tab[(xor(c, b) & 255) + 1])), 4294967295::BIGINT) % {MOST_LENT + 1} AS h
  FROM o, crc),
s AS (
  SELECT h.conv_id, list_concat(coalesce(l.ks[1:h.h], []), h.ks[h.h + 1:]) AS ks, list_concat(coalesce(l.cs[1:h.h], []), h.cs[h.h + 1:]) AS cs
  FROM h LEFT JOIN o l ON l.conv_id = h.base),
p AS (
  SELECT conv_id, d, sha256(array_to_string(ks[1:d], ',')) AS key, CASE WHEN d > 0 THEN sha256(array_to_string(ks[1:d - 1], ',')) END AS up,
         CASE WHEN d > 0 THEN cs[d] ELSE 0 END AS chars, d = len(ks) AS ends
  FROM s, LATERAL (SELECT unnest(range(0, len(s.ks) + 1)) AS d) d),
n AS (
  SELECT key, any_value(up) AS up, any_value(d) AS depth, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(chars) AS chars,
         sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256
  FROM p GROUP BY key),
k AS (SELECT up AS key, count(*) AS n_children FROM n WHERE up IS NOT NULL GROUP BY up),
c AS (SELECT n.*, coalesce(n_children, 0) AS n_children FROM n LEFT JOIN k USING (key)),
sub AS (
  SELECT p.key, sum(CASE WHEN c.n_children = 0 THEN 1 ELSE 0 END)::BIGINT AS n_leaves, sum((c.n_convs - 1) * c.chars)::BIGINT AS saved_tokens
  FROM c JOIN p ON p.conv_id = c.conv_id AND p.d <= c.depth GROUP BY p.key)
SELECT c.conv_id, c.depth, u.conv_id AS parent_conv_id, c.n_convs, c.n_children, n_leaves, saved_tokens, c.ends_sha256
FROM c JOIN sub USING (key) LEFT JOIN n u ON u.key = c.up
"""
