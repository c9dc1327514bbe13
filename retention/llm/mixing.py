"""Mixing sources to target weights by systematic sampling.

A source's share of all words is its weight's; no source gives more than ``MAX_COPIES`` times its
words, and what it can't give goes to the others by weight. Each document of a source then has the
same expected number of copies, target over size. Documents stand in a fixed order; the running sum
of expected copies plus one random offset of the source is cut at the integers, and a document is
taken once for each integer that its part of the sum crosses. All sums are in whole numbers, so
reruns agree, and a document is taken ``floor`` or ``ceil`` of the expected copies, never more than
``MAX_COPIES`` times.

The order is by size (to 2^-9 of it), then by digest. Along it, copies taken and copies expected
differ by less than one, so a source's taken words differ from its target by little more than its
largest document at most.

A source may hold most of the rows. The running sum is made in three steps: over the size bins of a
source (at most 22,528 for sizes below 2^31), over 4096 digest ranges of a bin, over the rows of a
range. Identical rows are counted first and expanded in blocks at the end. Sources are ranked over
range partitions, not in one window.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from retention.session import materialize

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = 3
MAX_COPIES = 3
SEED = 42
#: Sizes of up to so many bits are bins of their own; larger ones share their leading bits.
BIN_BITS = 10
#: Hexadecimal digits of the digest that name a range of a bin.
RANGE_DIGITS = 3
#: Identical rows that one row stands for while they are expanded.
BLOCK = 4096
#: Hexadecimal digits of a source's offset, and its steps in one.
OFFSET_DIGITS, OFFSETS = 5, 16**5
#: Partitions over which sources are ranked.
RANK_PARTS = 32


def _big(c) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("decimal(38,0)")


def _key() -> Column:
    """A source's name as a key that is never null."""
    return F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit(""))


def _before(value: str, order: str, *keys: str) -> Column:
    """The sum over the rows before, in ``order`` within ``keys``."""
    rows = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum(value).over(rows), F.lit(0))


def size_bin(size: Column) -> Column:
    """A number that never falls as ``size`` grows: the leading bits, above them the count of the others."""
    drop = F.greatest(F.length(F.bin(size)) - BIN_BITS, F.lit(0))
    return (F.call_function("shiftright", size, drop) + drop * (1 << BIN_BITS)).cast("int")


def sized(docs: DataFrame) -> DataFrame:
    """(doc_id, source, size, h, m): the words of the whole text, a digest of id and text, and the number
    of such rows. Reads the three columns it needs."""
    text = F.coalesce(F.col("text"), F.lit(""))
    name = F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), text)
    rows = docs.select("doc_id", "source", F.regexp_count(text, F.lit(WORD)).cast("bigint").alias("size"), F.md5(name.cast("binary")).alias("h"))
    return rows.groupBy("doc_id", "source", "size", "h").agg(F.count("*").alias("m"))


def weighted(sizes: DataFrame) -> DataFrame:
    """(source, source_size, w): sources by code point, null last, weigh 1, 2, 3, repeating.

    ``sizes`` has a row a source. They are ranked within range partitions, then moved on by the counts
    of the partitions before (``RANK_PARTS`` rows), so that any number of sources will do."""
    order = F.col("source").asc_nulls_last()
    placed = materialize(sizes.repartitionByRange(RANK_PARTS, order).withColumn("_part", F.spark_partition_id()))
    before = F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    starts = placed.groupBy("_part").agg(F.count("*").alias("_n")).select("_part", F.coalesce(before, F.lit(0)).alias("_before"))
    rank = F.row_number().over(Window.partitionBy("_part").orderBy(order)) - 1 + F.col("_before")
    return placed.join(F.broadcast(starts), "_part").select("source", "source_size", (F.pmod(rank, F.lit(WEIGHTS)) + 1).cast("int").alias("w"))


def targets(ranked: DataFrame) -> DataFrame:
    """(source, source_size, target, num, den): the words asked of each source, and the expected copies
    of each of its documents as num / den.

    Each round gives the words that are left to the sources not yet stopped, by weight, and stops those
    that would exceed ``MAX_COPIES`` times their size; it ends when none does. A round reads a row a
    source and brings two sums and a count to the driver."""
    rows = materialize(ranked.withColumn("_cap", F.col("source_size") * MAX_COPIES).withColumn("_stopped", F.lit(False)))
    before = -1
    while True:
        left, weight, stopped = rows.agg(
            F.sum(_big("source_size")) - F.sum(F.when(F.col("_stopped"), _big("_cap")).otherwise(_big(F.lit(0)))),
            F.sum(F.when(~F.col("_stopped"), F.col("w"))), F.count(F.when(F.col("_stopped"), 1))).first()
        left, weight = int(left or 0), int(weight or 1)
        if stopped == before:
            break
        over = _big("_cap") * _big(F.lit(weight)) < _big("w") * _big(F.lit(left))
        rows, before = materialize(rows.withColumn("_stopped", F.col("_stopped") | over)), stopped
    share = _big("w") * _big(F.lit(left))
    return rows.select(
        "source", "source_size",
        F.when(F.col("_stopped"), F.col("_cap").cast("double")).otherwise(share.cast("double") / F.lit(float(weight))).alias("target"),
        F.when(F.col("_stopped"), _big(F.lit(MAX_COPIES))).otherwise(share).alias("num"),
        F.when(F.col("_stopped"), _big(F.lit(1))).otherwise(F.greatest(_big("source_size") * _big(F.lit(weight)), _big(F.lit(1)))).alias("den"))


def crossings(place: Column) -> Column:
    """Integers up to the sum of expected copies of the first ``place`` documents of a source, plus its offset."""
    total = _big(place) * F.col("num") * _big(F.lit(OFFSETS)) + F.col("u") * F.col("den")
    return F.call_function("div", total, F.col("den") * _big(F.lit(OFFSETS)))


def mix(docs: DataFrame) -> DataFrame:
    """(doc_id, size, source_size, target, taken) of every document; ``taken`` is its words times its copies.

    Defined cases: null text: no words, taken 0; null id: a document like any other; null source: one
    source, the last; repeated rows: each counts and is sampled by itself; a source without words has
    target 0; very long texts: counted whole, in one row of their own; empty table: no rows; other
    columns aren't read.
    """
    rows = materialize(sized(docs).select(
        "*", _key().alias("k"), size_bin(F.col("size")).alias("bin"), F.substring("h", 1, RANGE_DIGITS).alias("range")))
    asked = targets(weighted(rows.groupBy("source").agg(F.sum(F.col("size") * F.col("m")).alias("source_size"))))
    offset = F.conv(F.substring(F.md5(F.concat(F.lit(f"{SEED}:"), F.col("k")).cast("binary")), 1, OFFSET_DIGITS), 16, 10)
    asked = asked.withColumn("k", _key()).withColumn("u", _big(offset)).drop("source")

    ranges = rows.groupBy("k", "bin", "range").agg(F.sum("m").alias("n"))
    bins = ranges.groupBy("k", "bin").agg(F.sum("n").alias("n"))
    bins = bins.select("k", "bin", _before("n", "bin", "k").alias("_bin"))
    starts = ranges.select("k", "bin", "range", _before("n", "range", "k", "bin").alias("_range")).join(bins, ["k", "bin"])
    starts = starts.select("k", "bin", "range", (F.col("_bin") + F.col("_range")).alias("start")).join(asked, "k")

    placed = rows.join(starts, ["k", "bin", "range"]).withColumn("start", F.col("start") + _before("m", "h", "k", "bin", "range"))
    blocks = placed.withColumn("_block", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("m") - 1, F.lit(BLOCK).cast("bigint"))))
    each = blocks.withColumn("_at", F.explode(F.sequence("_block", F.least(F.col("_block") + BLOCK, F.col("m")) - 1)))
    place = F.col("start") + F.col("_at")
    copies = crossings(place + 1) - crossings(place)
    return each.select("doc_id", "size", "source_size", "target", (copies * F.col("size")).alias("taken"))


ORACLE_SQL = f"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size,
         md5(coalesce(doc_id::VARCHAR, '') || ':' || coalesce(text, '')) AS h
  FROM documents),
binned AS (SELECT *, greatest(length(bin(size)) - {BIN_BITS}, 0) AS cut FROM d),
s AS (
  SELECT source, sum(size)::HUGEINT AS z, ((row_number() OVER (ORDER BY source NULLS LAST) - 1) % {WEIGHTS} + 1)::HUGEINT AS w,
         ('0x' || substr(md5('{SEED}:' || coalesce('=' || source, '')), 1, {OFFSET_DIGITS}))::BIGINT::HUGEINT AS u
  FROM d GROUP BY source),
o AS (
  SELECT *, sum(z) OVER () AS total, coalesce(sum({MAX_COPIES} * z) OVER (l ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::HUGEINT AS capped,
         (sum(w) OVER (l ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::HUGEINT AS open
  FROM s WINDOW l AS (ORDER BY z * 6 // w, source NULLS LAST)),
p AS (SELECT *, {MAX_COPIES} * z * open < w * (total - capped) AS stopped FROM o),
f AS (
  SELECT (max(total) - coalesce(sum({MAX_COPIES} * z) FILTER (stopped), 0))::HUGEINT AS remaining, (sum(w) FILTER (NOT stopped))::HUGEINT AS weight
  FROM p),
t AS (
  SELECT source, z, u, CASE WHEN stopped THEN ({MAX_COPIES} * z)::DOUBLE ELSE (w * remaining)::DOUBLE / weight::DOUBLE END AS target,
         CASE WHEN stopped THEN {MAX_COPIES}::HUGEINT ELSE w * remaining END AS num,
         CASE WHEN stopped THEN 1::HUGEINT ELSE greatest(z * weight, 1::HUGEINT) END AS den
  FROM p, f),
r AS (
  SELECT doc_id, source, size, (row_number() OVER (PARTITION BY source ORDER BY (size >> cut) + cut * {1 << BIN_BITS}, h) - 1)::HUGEINT AS place
  FROM binned)
SELECT r.doc_id, r.size, t.z::BIGINT AS source_size, t.target,
       ((((place + 1) * num * {OFFSETS} + u * den) // (den * {OFFSETS}) - (place * num * {OFFSETS} + u * den) // (den * {OFFSETS})) * r.size)::BIGINT AS taken
FROM r JOIN t ON r.source IS NOT DISTINCT FROM t.source
"""
