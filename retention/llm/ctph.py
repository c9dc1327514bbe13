"""Context-triggered piecewise fingerprints of texts, and their likeness.

A hash of the last ``WINDOW`` bytes rolls over the UTF-8 text; where it ends in k zero bits, a chunk
ends. k (the block size is 2^k) is the smallest, from an eighth of the expected size on, that gives
at most 64 chunks. A chunk's symbol is 12
bits of the sum of its rolling hashes. The fingerprint is ``k:symbols:symbols at k+1``, so that texts
whose sizes differ by a factor of two still share a block size. The likeness of two fingerprints is
1 - d / (m + n): d is the edit distance (insertions and deletions) of two symbol strings of m and n
symbols at a block size that both have, the larger value if they share both; 0 if they share none.
Distances are computed for many pairs at once, a 64-bit word per pair.

Whole texts count, in blocks of bytes: memory doesn't grow with their length beyond the text.

Defined cases: null or empty text: fingerprint ``0::``, like another empty text's (1.0) and unlike
all others (0.0); documents of equal ids are ordered by their texts; null ids come last; a table of
one row is its own next document; empty table: no rows.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retention.llm.common import map_rows, texts_of

WINDOW, MAX_CHUNKS = 8, 64
BLOCK = 1 << 20
#: Fixed odd multipliers of the rolling hash and of its mixing step.
ROLL, MIX = 0x9E3779B97F4A7C15, np.uint64(0xD6E8FEB86659FD93)
_ROLL1, _ROLL2, _ROLL4 = (np.uint64(pow(ROLL, n, 1 << 64)) for n in (1, 2, 4))
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
_VALUE = {c: i for i, c in enumerate(ALPHABET)}


def _rolled(block: np.ndarray) -> np.ndarray:
    """Mixed hashes of the windows that end at each byte but the first WINDOW - 1."""
    x = block.astype(np.uint64) + np.uint64(1)
    x = x[1:] + x[:-1] * _ROLL1
    x = x[2:] + x[:-2] * _ROLL2
    x = x[4:] + x[:-4] * _ROLL4
    x ^= x >> np.uint64(32)
    x *= MIX
    x ^= x >> np.uint64(32)
    return x


def fingerprint(text: str) -> str:
    data = text.encode()
    n = len(data)
    if not n:
        return "0::"
    least = max(0, (n // MAX_CHUNKS).bit_length() - 4)  # about 512 places or more end in so many zero bits
    mask = np.uint64((1 << least) - 1)
    ends, sums, levels = [], [], []
    total = np.uint64(0)
    padded = bytes(WINDOW - 1) + data
    for at in range(0, n, BLOCK):
        x = _rolled(np.frombuffer(padded, np.uint8, min(BLOCK, n - at) + WINDOW - 1, at))
        run = np.cumsum(x, dtype=np.uint64) + total
        total = run[-1]
        hit = np.flatnonzero((x & mask) == 0)
        low = x[hit]
        low = np.where(low == 0, np.uint64(1 << 62), low & (~low + np.uint64(1)))
        ends.append(hit + at)
        sums.append(run[hit])
        levels.append(np.log2(low.astype(np.float64)).astype(np.int64))
    ends, sums, levels = np.concatenate(ends), np.concatenate(sums), np.concatenate(levels)
    inner = ends < n - 1
    sums, levels = sums[inner], levels[inner]
    over = np.cumsum(np.bincount(levels, minlength=64)[::-1])[::-1]  # ends of each level or more
    k = max(least, int(np.argmax(over < MAX_CHUNKS)))

    def symbols(level: int) -> str:
        s = np.append(sums[levels >= level], total)
        c = np.diff(np.append(np.uint64(0), s))
        c = ((c ^ (c >> np.uint64(31))) * MIX) >> np.uint64(52)
        return "".join(ALPHABET[v >> 6] + ALPHABET[v & 63] for v in c.tolist())

    return f"{k}:{symbols(k)}:{symbols(k + 1)}"


def _symbols(s: str) -> list[int]:
    return [_VALUE[a] << 6 | _VALUE[b] for a, b in zip(s[::2], s[1::2])]


def _likeness(pairs: list[tuple[str, str]]) -> np.ndarray:
    """1 - d / (m + n) of symbol strings (at most 64 symbols): bit-parallel common subsequences."""
    a, b = np.full((len(pairs), 64), -1, np.int16), np.full((len(pairs), 64), -2, np.int16)
    m, n = np.zeros(len(pairs), np.int64), np.zeros(len(pairs), np.int64)
    for i, (x, y) in enumerate(pairs):
        x, y = _symbols(x), _symbols(y)
        a[i, :len(x)], b[i, :len(y)], m[i], n[i] = x, y, len(x), len(y)
    rows = np.full(len(pairs), ~np.uint64(0))
    for j in range(int(n.max(initial=0))):
        match = np.packbits(a == b[:, j:j + 1], axis=1, bitorder="little").view(np.uint64)[:, 0]
        u = rows & match
        rows = (rows + u) | (rows - u)
    common = np.unpackbits((~rows).view(np.uint8).reshape(-1, 8), axis=1).sum(axis=1, dtype=np.int64)
    return np.where(m + n > 0, 2 * common / np.maximum(m + n, 1), 1.0)


def likeness(pairs: list[tuple[str, str]]) -> list[float]:
    """Likeness (0 to 1) of pairs of fingerprints."""
    todo, owner = [], []
    for i, (x, y) in enumerate(pairs):
        (k, x1, x2), (l, y1, y2) = x.split(":"), y.split(":")
        k, l = int(k), int(l)
        for s, t in ([(x1, y1), (x2, y2)] if k == l else [(x1, y2)] if k == l + 1 else [(x2, y1)] if l == k + 1 else []):
            if bool(x1) == bool(y1):
                todo.append((s, t))
                owner.append(i)
    out = np.zeros(len(pairs))
    if todo:
        np.maximum.at(out, owner, _likeness(todo))
    return [1.0 if x == y else float(v) for (x, y), v in zip(pairs, out)]


def in_order(docs: DataFrame) -> DataFrame:
    """(doc_id, text, _bucket, _copy): documents cut into ranges of ids, each range in one partition
    in descending order, followed by a copy of the first documents of the range that comes next
    (the first range after the last), so that each row's successor is at hand. One shuffle of the
    texts; a first pass over the ids alone finds the ranges."""
    from pyspark.ml.feature import Bucketizer

    spark = docs.sparkSession
    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    texts = texts_of(docs)
    ranges = 4 * parts  # a hash deals ranges to partitions: several each, to even out
    keyed = texts.withColumn("_key", F.coalesce(F.col("doc_id").cast("double"), F.lit(float("-inf"))))
    found = texts.select(F.col("doc_id").cast("double").alias("_key")).approxQuantile("_key", [i / ranges for i in range(1, ranges)], 1 / (4 * ranges))
    inner = sorted(set(found))
    if inner:
        keyed = Bucketizer(splits=[float("-inf"), *inner, float("inf")], inputCol="_key", outputCol="_at").transform(keyed).withColumn("_bucket", F.col("_at").cast("int"))
    else:
        keyed = keyed.withColumn("_bucket", F.lit(0))
    tops = sorted((r["_bucket"], r["_key"]) for r in keyed.select("_bucket", "_key").groupBy("_bucket").agg(F.max("_key").alias("_key")).collect())  # a row a range
    to = [(b, k, tops[(i + 1) % len(tops)][0]) for i, (b, k) in enumerate(tops)]
    small = spark.createDataFrame(to, "_bucket int, _key double, _to int")
    own = F.struct(F.col("_bucket"), F.lit(0).alias("_copy"))
    copy = F.struct(F.col("_to").alias("_bucket"), F.lit(1).alias("_copy"))
    placed = (
        keyed.join(F.broadcast(small), ["_bucket", "_key"], "left")
        .select("doc_id", "text", F.explode(F.when(F.col("_to").isNull(), F.array(own)).otherwise(F.array(own, copy))).alias("_place"))
        .select("doc_id", "text", "_place._bucket", "_place._copy")
    )
    return placed.repartition(parts, "_bucket").sortWithinPartitions("_bucket", "_copy", F.desc_nulls_last("doc_id"), F.xxhash64("text"), "text")


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, fingerprint), for users of the operator."""
    return map_rows(texts_of(docs), lambda source: ((r["doc_id"], fingerprint(r["text"])) for r in source), "doc_id bigint, fingerprint string")


def edited_fingerprints(docs: DataFrame, batch: int = 256) -> DataFrame:
    """Fingerprints of all documents and of their edited texts (the second half replaced by the
    beginning of the next document in descending order of ids), with both likenesses."""

    def pairs(source):
        """(row, its fingerprint, next text, next fingerprint)"""
        held = None
        for r in source:
            if held is not None and held[0]["_bucket"] != r["_bucket"]:
                held = None
            if held is not None and held[0]["_copy"]:
                continue  # further copies: documents that share the first one's id
            mark = fingerprint(r["text"])
            if held is not None:
                yield held[0], held[1], r["text"], mark
            held = (r, mark)

    def rows(source):
        group = []
        for row, own, following, mark in pairs(source):
            n = len(row["text"])
            text = row["text"][:n - n // 2] + following[:n // 2]
            group.append((row["doc_id"], n, hashlib.sha256(text.encode()).hexdigest(), own, fingerprint(text), mark))
            if len(group) == batch:
                yield from scored(group)
                group = []
        yield from scored(group)

    def scored(group):
        near = likeness([(g[3], g[4]) for g in group] + [(g[3], g[5]) for g in group])
        for i, g in enumerate(group):
            yield (*g[:5], near[i], near[len(group) + i])

    return map_rows(in_order(docs), rows, "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")
