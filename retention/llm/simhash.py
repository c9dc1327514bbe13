"""Near duplicates by SimHash fingerprints and a segment-popcount embedding.

A fingerprint's bits are the majority of the bits of its shingles' hashes. Its embedding counts the
bits set in each of 16 segments of 4 bits; the Manhattan distance of two embeddings is at most the
Hamming distance of the fingerprints. So fingerprints that differ in two bits or fewer lie within
distance 2 in the grid of embeddings, and there is a grid cell within distance 1 of both. Each
distinct fingerprint is put in its own cell and the up to 32 cells next to it; fingerprints that meet
in a cell are verified exactly by their differing bits.

A cell of more than ``CROWDED`` fingerprints doesn't emit its pairs: its members are put again in an
embedding with one bit a segment, where a cell within distance 1 of two fingerprints proves that they
differ in two bits or fewer, so that a star to the cell's smallest member has the same components.
No link is lost and no group emits all its pairs. Equal fingerprints are one class from the start.
"""

from __future__ import annotations

from functools import partial
from itertools import repeat

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from retention.llm.common import map_rows, texts_of
from retention.llm.graph import components
from retention.session import materialize, scratch_path

SEED, RADIUS = 42, 2
#: Fingerprints in a cell beyond which its pairs aren't emitted.
CROWDED = 48
#: Bytes of a text that are split at once.
BLOCK = 1 << 20


def word_blocks(data: bytes):
    """The words of a text in lists, in order; memory is bounded by ``BLOCK`` and the longest word."""
    at = 0
    while at < len(data):
        end = at + BLOCK
        if end < len(data):
            ends = [e for c in b" \n\t\r\x0b\x0c" if (e := data.find(c, end, end + 4096)) >= 0]
            while not ends and end < len(data):
                end += 4096
                ends = [e for c in b" \n\t\r\x0b\x0c" if (e := data.find(c, end, end + 4096)) >= 0]
            end = min(ends, default=len(data))
        yield data[at:end].split()
        at = end


def shingle_hashes(text: str, size: int):
    """Blocks of the XXH64 hashes of a text's shingles, in order, repeats included. A text of fewer
    words has one: the whole sequence; a text without words has none."""
    import xxhash

    digest = partial(xxhash.xxh64_intdigest, seed=SEED)
    kept: list[bytes] = []
    total = 0
    for words in word_blocks(text.encode().lower()):
        total += len(words)
        words = kept + words
        if total >= size and len(words) >= size:
            joined = b" ".join(words)
            ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
            starts = np.append(0, ends[:-1] + 1)
            n = len(words) - size + 1
            cut = map(joined.__getitem__, map(slice, starts[:n].tolist(), ends[size - 1:].tolist()))
            yield np.fromiter(map(digest, cut), np.uint64, n)
            words = words[n:]
        kept = words
    if 0 < total < size:
        yield np.array([digest(b" ".join(kept))], np.uint64)


def fingerprint(blocks) -> int:
    """The majority of each bit over blocks of hashes, as an unsigned integer; 0 without hashes."""
    ones, n = np.zeros(64, np.int64), 0
    for h in blocks:
        for at in range(0, len(h), 1 << 14):
            part = h[at:at + (1 << 14)]
            ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.uint16)
        n += len(h)
    return int(np.packbits(2 * ones > n, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """(doc_id, fp): the fingerprint as a signed 64-bit integer. A narrow map over whole texts."""
    return _marked(texts_of(docs), shingle, "doc_id bigint")


def _marked(texts: DataFrame, shingle: int, keys: str) -> DataFrame:
    """The columns ``keys`` of (..., text) and fp."""
    names = [k.split()[0] for k in keys.split(", ")]

    def rows(source):
        for r in source:
            fp = fingerprint(shingle_hashes(r["text"], shingle))
            yield *(r[k] for k in names), fp - (1 << 64) if fp >> 63 else fp

    return map_rows(texts, rows, f"{keys}, fp bigint")


def embedding(fp: Column) -> Column:
    """The bit counts of 16 segments of 4 bits, a hexadecimal digit each."""
    even, odd = fp.bitwiseAND(F.lit(0x5555555555555555)), F.shiftrightunsigned(fp, 1).bitwiseAND(F.lit(0x5555555555555555))
    pairs = even.bitwiseXOR(odd).bitwiseOR(F.shiftleft(even.bitwiseAND(odd), 1))  # counts of two bits; a sum could overflow
    return pairs.bitwiseAND(F.lit(0x3333333333333333)) + F.shiftrightunsigned(pairs, 2).bitwiseAND(F.lit(0x3333333333333333))


def _cells(cell: Column) -> Column:
    """A cell and the cells at Manhattan distance 1 from it."""
    near = [F.array(cell)]
    for i in range(16):
        count = F.shiftrightunsigned(cell, 4 * i).bitwiseAND(F.lit(15))
        near.append(F.when(count < 4, F.array(cell + F.lit(1 << 4 * i))).otherwise(F.array().cast("array<bigint>")))
        near.append(F.when(count > 0, F.array(cell - F.lit(1 << 4 * i))).otherwise(F.array().cast("array<bigint>")))
    return F.concat(*near)


def links(distinct: DataFrame) -> DataFrame:
    """(a, b): links between fingerprints (column fp, distinct) of at most two differing bits, whose
    components are those of all such links. ``distinct`` is read more than once: pass a materialised frame."""
    placed = distinct.select("fp", F.explode(_cells(embedding(F.col("fp")))).alias("cell"))
    met = materialize(placed.groupBy("cell").agg(F.count("*").alias("n"), F.min("fp").alias("a"), F.max("fp").alias("b")).where("n > 1"))
    few = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= RADIUS
    two = met.where("n = 2").select("a", "b").where(few)
    some = placed.join(met.where(f"n > 2 and n <= {CROWDED}").select("cell"), "cell")
    pairs = some.select("cell", F.col("fp").alias("a")).join(some.select("cell", F.col("fp").alias("b")), "cell").where(F.col("a") < F.col("b")).where(few)
    crowded = placed.join(met.where(f"n > {CROWDED}").select("cell"), "cell").select("fp").distinct()
    bits = F.array(F.col("fp"), *(F.col("fp").bitwiseXOR(F.lit((1 << i) - (1 << 64 if i == 63 else 0))) for i in range(64)))
    corner = crowded.select("fp", F.explode(bits).alias("cell"))
    least = corner.groupBy("cell").agg(F.min("fp").alias("a"), F.count("*").alias("n")).where("n > 1").drop("n")
    stars = corner.join(least, "cell").select("a", F.col("fp").alias("b")).where("a != b")
    return two.unionByName(pairs.select("a", "b")).unionByName(stars).distinct()


def near_duplicates(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """(doc_id, fingerprint, component_id): documents whose fingerprints differ in at most two bits,
    directly or through others, share a component, named by its smallest doc_id.

    Defined cases: null text: empty; no words: fingerprint zero, linked like any other; null ids count
    only where a component has no others (then its id is null); repeated rows: one row each, in one
    component; empty table: no rows; texts of any length are hashed whole, in blocks.
    """
    marked = materialize(fingerprints(docs, shingle))
    rooted = _rooted(marked, F.min("doc_id"))
    named = rooted.join(rooted.groupBy("_root").agg(F.min("_least").alias("component_id")), "_root").select("fp", "component_id")
    return marked.join(named, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def _rooted(marked: DataFrame, least: Column) -> DataFrame:
    """(fp, _least, _root): each distinct fingerprint, the least of its documents and its component."""
    distinct = materialize(marked.groupBy("fp").agg(least.alias("_least")))
    found = components(links(distinct.select("fp")))
    return distinct.join(found.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "_least", F.coalesce("root", "fp").alias("_root"))


def without_near_duplicates(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """One document of each component of ``near_duplicates``: the one with the smallest doc_id. Columns as they came.

    The rows are written once with a row number, so that a lost executor can't number them anew;
    fingerprints and numbers alone meet, and the texts are read again for those that stay.

    Defined cases: null text, empty text and texts without words are one group; null ids stay only
    where a component has no others; of equal ids the first in the order in which the rows were written; empty
    table: no rows; texts of any length are hashed whole, in blocks; columns named like this module's
    own can't clash, as the row travels as one struct.
    """
    path = scratch_path(docs.sparkSession, "near")
    docs.select(F.struct("*").alias("_doc"), F.monotonically_increasing_id().alias("_rk")).write.option("compression", "zstd").parquet(path)
    stored = docs.sparkSession.read.parquet(path)
    texts = stored.select("_rk", F.col("_doc.doc_id").alias("doc_id"), F.coalesce("_doc.text", F.lit("")).alias("text"))
    marked = materialize(_marked(texts, shingle, "_rk bigint, doc_id bigint"))
    rooted = _rooted(marked, F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "_rk")))
    stays = rooted.groupBy("_root").agg(F.min("_least").alias("_least")).select("_least._rk")
    return stored.join(stays, "_rk", "left_semi").select(*(F.col("_doc").getField(c).alias(c) for c in docs.columns))
