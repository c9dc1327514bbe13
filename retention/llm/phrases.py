"""Phrase collocations from an FM-index per shard.

1. A task writes its texts as shards: word ids (0 breaks the text at punctuation and between
   documents) and the shard's words. It also counts words and word pairs by hash buckets, in tables
   of fixed size.
2. The tables are summed. A bucket below the least count holds no frequent word or pair. What is left
   is counted once more, by buckets of three and four words, and its words are marked. The bits of all
   tables, 13 MB whatever the corpus, are broadcast.
3. A shard's text is broken wherever a word or pair is certainly rare, as no candidate runs across
   it; the FM-index of what is left (``fm_index``) enumerates its phrases of up to four words with
   their counts in the shard, leaving out those that are certainly rare.
4. A shard deals its phrases to parts by their hashes and writes a row for each part: sorted, compressed.
   Counts are summed over the shards, part by part. What follows works on phrases of at least the least count:
   extensions to the left and right, cuts, scores and ranks.

A one-word extension of a phrase is at least as frequent as any longer one around it, so the drop
rule needs the extensions by one word only. At corpora so large that every bucket is full, raise
``BITS``: results are the same for any, only the rows of step 3 change.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from retention.llm.fm_index import Bidirectional
from retention.session import materialize, ship_package

LEAST, LONGEST, TOP, SCALE, DROP_PERCENT = 30, 4, 2000, 2_000_000, 80
#: Hash buckets for phrases of one to four words (as powers of two), and buckets in a block of a table.
BITS, BLOCK_BITS = {1: 21, 2: 24, 3: 24, 4: 24}, 16
#: Each phrase has a bucket in each of two tables, by one of these factors. Table 0 is of the words of frequent pairs.
FACTORS = (0xD6E8FEB86659FD93, 0xC2B2AE3D27D4EB4F)
NEEDED = 0
#: Bytes of text in a shard, bytes of text that a task holds for all its languages, bytes split at once.
SHARD_BYTES, HELD_BYTES, SPLIT_BYTES = 8 << 20, 16 << 20, 2 << 20
#: Rows in a batch that a task writes at once.
OUT_ROWS = 50_000
#: Phrases in a part, by the bits set, and phrases of several shards that a task holds before it sums them.
PART_PHRASES, HELD_PHRASES = 200_000, 1_000_000
#: Groups that a language's candidates are ranked in before its first ones are.
RANK_GROUPS = 256

BREAK = b"."
_SAME = bytes(range(256)).translate(bytes.maketrans(b",;:!?\n\x0b\x0c\r\tABCDEFGHIJKLMNOPQRSTUVWXYZ", b"......... abcdefghijklmnopqrstuvwxyz"))

SHARDS = "lang string, words binary, ids binary, kind int, block int, counts binary"
BLOCKS = "kind int, block int, counts binary"
PARTS = "lang string, part int, phrases binary, counts binary"
FOUND = "lang string, words int, phrase string, f bigint"


def pack(data: bytes) -> bytes:
    """Compressed, after its size."""
    return len(data).to_bytes(8, "little") + pa.compress(data, codec="zstd", asbytes=True)


def unpack(data: bytes) -> bytes:
    return pa.decompress(data[8:], int.from_bytes(data[:8], "little"), codec="zstd", asbytes=True)


class Ids(dict):
    """Numbers words as they come."""

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        return n


def word_ids(texts: list[bytes]) -> tuple[np.ndarray, list[bytes]]:
    """The ids of all words, 0 for breaks, and the words by id."""
    ids = Ids({BREAK: 0})
    parts = [np.zeros(1, np.int32)]
    for text in texts:
        at = 0
        while at < len(text):
            end = text.find(b" ", at + SPLIT_BYTES)
            end = len(text) if end < 0 else end
            words = text[at:end].translate(_SAME).replace(BREAK, b" . ").split()
            parts.append(np.fromiter(map(ids.__getitem__, words), np.int32, len(words)))
            at = end
        parts.append(np.zeros(1, np.int32))
    return np.concatenate(parts), list(ids)


def word_hashes(lang: str, words: list[bytes]) -> np.ndarray:
    import xxhash

    head = lang.encode() + b"\0"
    return np.fromiter((xxhash.xxh64_intdigest(head + w) for w in words), np.uint64, len(words))


def gram_hashes(h: list[np.ndarray]) -> np.ndarray:
    """A hash of each phrase; ``h`` has its words' hashes, an array for each place."""
    mixed = h[0]
    for after in h[1:]:
        mixed = (mixed * np.uint64(0x9E3779B97F4A7C15)) ^ after
    return mixed


def text_hashes(h: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """The hash of the ``k`` words from each place of a text."""
    at = h[ids]
    return gram_hashes([at[i:len(at) - k + 1 + i] for i in range(k)])


def buckets(hashes: np.ndarray, k: int, side: int) -> np.ndarray:
    return (hashes * np.uint64(FACTORS[side])) >> np.uint64(64 - BITS[max(k, 1)])


class Counts:
    """Counts by bucket, no higher than ``LEAST``, of phrases of ``k`` words for each ``k`` given."""

    def __init__(self, sizes: list[int]):
        self.tables = {(k, side): np.zeros(1 << BITS[max(k, 1)], np.uint16) for k in sizes for side in (0, 1)}

    def add(self, k: int, hashes: np.ndarray, n: np.ndarray | None = None) -> None:
        """Adds phrases, each as often as it stands there, or distinct ones with their counts."""
        if n is None:
            hashes, n = np.unique(hashes, return_counts=True)
        n = np.minimum(n, LEAST).astype(np.uint16)
        for side in (0, 1):
            table, at = self.tables[k, side], buckets(hashes, k, side)
            for some in range(0, len(at), 1 << 10):  # a bucket's count stays below 2^16 until it is cut
                here = at[some:some + (1 << 10)]
                np.add.at(table, here, n[some:some + (1 << 10)])
                table[here] = np.minimum(table[here], LEAST)

    def blocks(self):
        """(k, block, places and counts) of each block that has any; the second table's blocks follow the first's."""
        for (k, side), table in self.tables.items():
            count = len(table) >> BLOCK_BITS
            for block in range(count):
                here = table[block << BLOCK_BITS:(block + 1) << BLOCK_BITS]
                used = np.flatnonzero(here)
                if len(used):
                    steps = np.diff(used, prepend=0).astype(np.uint16)
                    yield k, side * count + block, pack(steps.tobytes() + here[used].astype(np.uint8).tobytes())


class Frequent:
    """Bits of the buckets that reach ``LEAST``, two tables in a row for each number of words."""

    def __init__(self):
        self.bits: dict[int, np.ndarray] = {}

    def has(self, hashes: np.ndarray, k: int) -> np.ndarray:
        """Whether each phrase of ``k`` words may be frequent: both its buckets are."""
        found = np.ones(len(hashes), bool)
        for side in (0, 1):
            at = buckets(hashes, k, side) + np.uint64(side << BITS[max(k, 1)])
            found &= (self.bits[k][at >> np.uint64(3)] >> (np.uint64(7) - (at & np.uint64(7))).astype(np.uint8)) & 1 > 0
        return found


def pairs_kept(h: np.ndarray, ids: np.ndarray, frequent: Frequent) -> np.ndarray:
    """Whether each word and the next may be a frequent pair of frequent words."""
    known = frequent.has(h, 1)
    known[0] = False
    return known[ids[:-1]] & known[ids[1:]] & frequent.has(text_hashes(h, ids, 2), 2)


def _batch(schema: pa.Schema, columns: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def _arrow(fields):
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(fields)


def _write_shards(fields):
    def run(batches):
        schema = _arrow(fields)
        counts = Counts([1, 2])
        held, size = {}, {}

        def shard(lang):
            ids, words = word_ids(held.pop(lang))
            size.pop(lang)
            h = word_hashes(lang, words)
            counts.add(1, h[1:], np.bincount(ids, minlength=len(words))[1:])
            counts.add(2, text_hashes(h, ids, 2)[(ids[:-1] > 0) & (ids[1:] > 0)])
            return _batch(schema, [[lang], [pack(b"\n".join(words))], [pack(ids.tobytes())], [None], [None], [None]])

        for b in batches:
            for at in range(0, b.num_rows, 256):
                part = b.slice(at, 256)
                for lang, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    data = text.encode()
                    held.setdefault(lang, []).append(data)
                    size[lang] = size.get(lang, 0) + len(data)
                    if size[lang] > SHARD_BYTES:
                        yield shard(lang)
                    elif sum(size.values()) > HELD_BYTES:
                        yield shard(max(size, key=size.get))
        for lang in list(held):
            yield shard(lang)
        for k, block, data in counts.blocks():
            yield _batch(schema, [[None], [None], [None], [k], [block], [data]])

    return run


def _shards(batches):
    """(lang, words, ids) of each shard."""
    for b in batches:
        for row in range(b.num_rows):
            lang, words, ids = (b.column(i)[row].as_py() for i in range(3))
            yield lang, unpack(words).split(b"\n"), np.frombuffer(unpack(ids), np.int32)


def _count_longer(fields, bits):
    """Counts by bucket of the phrases of three and four words whose pairs may be frequent; marks the words of these pairs."""

    def run(batches):
        schema = _arrow(fields)
        counts = Counts([NEEDED, 3, 4])
        for lang, words, ids in _shards(batches):
            h = word_hashes(lang, words)
            pair = pairs_kept(h, ids, bits.value)
            for k in (3, 4):
                inside = np.logical_and.reduce([pair[i:len(pair) - k + 2 + i] for i in range(k - 1)])
                counts.add(k, text_hashes(h, ids, k)[inside])
            words = np.unique(kept_text(ids, pair))
            counts.add(NEEDED, h[words[words > 0]], np.full(int((words > 0).sum()), LEAST))
        for block in counts.blocks():
            yield _batch(schema, [[x] for x in block])

    return run


def _sum_blocks(fields):
    def run(batches):
        schema = _arrow(fields)
        sums = {}
        for b in batches:
            for kind, block, data in zip(*(c.to_pylist() for c in b.columns)):
                data = unpack(data)
                n = len(data) // 3
                total = sums.setdefault((kind, block), np.zeros(1 << BLOCK_BITS, np.uint8))
                used = np.cumsum(np.frombuffer(data, np.uint16, n), dtype=np.int64)
                total[used] = np.minimum(total[used] + np.frombuffer(data, np.uint8, n, 2 * n), LEAST)  # at most 2 * LEAST before
        for (kind, block), total in sums.items():
            yield _batch(schema, [[kind], [block], [np.packbits(total >= LEAST).tobytes()]])

    return run


def read_frequent(blocks: DataFrame, sizes: list[int], into: Frequent) -> None:
    """Adds the bits of the phrases of each number of words in ``sizes``."""
    fields = blocks.sparkSession.createDataFrame([], "kind int, block int, bits binary").schema
    into.bits |= {k: np.zeros(2 << BITS[max(k, 1)] >> 3, np.uint8) for k in sizes}
    width = 1 << BLOCK_BITS >> 3
    for r in blocks.repartition("kind", "block").mapInArrow(_sum_blocks(fields), fields).collect():  # at most 1088 rows of 8 KB
        into.bits[r.kind][r.block * width:(r.block + 1) * width] = np.frombuffer(r.bits, np.uint8)


def kept_text(ids: np.ndarray, pair: np.ndarray) -> np.ndarray:
    """The words that stand in a kept pair, in order, with a 0 after each run. ``pair[i]`` tells whether
    words i and i + 1 are kept as neighbours."""
    after = np.append(pair, False)
    before = np.append(False, pair)
    at = np.flatnonzero(after | before)
    ends = ~after[at]
    x = np.zeros(len(at) + int(ends.sum()), np.int32)
    x[np.arange(len(at)) + np.cumsum(ends) - ends] = ids[at]
    return x


def part_count(frequent: Frequent, least: int) -> int:
    """Parts of some ``PART_PHRASES`` phrases, by the buckets that are full in the first table of each number of words."""
    full = sum(int(np.unpackbits(frequent.bits[k][:len(frequent.bits[k]) // 2]).sum()) for k in (1, 2, 3, 4))
    return max(least, full // PART_PHRASES + 1)


def _phrases_of(fields, bits, parts: int):
    def run(batches):
        import pyarrow.compute as pc

        schema, frequent = _arrow(fields), bits.value

        def dealt(lang, phrases, counts, hashes):
            """A row for each part; a phrase's part is the same in all shards."""
            part = (hashes >> np.uint64(20)) % np.uint64(parts)
            order = np.asarray(pc.sort_indices(phrases))
            order = order[np.argsort(part[order], kind="stable")]
            ends = np.cumsum(np.bincount(part.astype(np.int64), minlength=parts))
            for i in range(parts):
                at = order[ends[i - 1] if i else 0:ends[i]]
                if len(at):
                    text = "\n".join(phrases.take(pa.array(at)).to_pylist()).encode()
                    yield _batch(schema, [[lang], [i], [pack(text)], [pack(counts[at].astype(np.int64).tobytes())]])

        for lang, words, ids in _shards(batches):
            h = word_hashes(lang, words)
            names = pa.array([w.decode() for w in words])
            counts = np.bincount(ids, minlength=len(words))
            yield _batch(schema, [[lang], [0], [pack(b"")], [pack(np.array([counts[1:].sum()], np.int64).tobytes())]])
            common = np.flatnonzero(frequent.has(h[1:], NEEDED) & frequent.has(h[1:], 1)) + 1
            yield from dealt(lang, names.take(pa.array(common)), counts[common], h[common])
            text = kept_text(ids, pairs_kept(h, ids, frequent))
            if not len(text):
                continue
            used, dense = np.unique(text, return_inverse=True)
            hashes = h[used]

            def kept(columns):
                return frequent.has(gram_hashes([hashes[w] for w in columns]), len(columns))

            for p in Bidirectional(dense.astype(np.int32), LONGEST).grams(LONGEST, kept):
                if len(p.count):
                    columns = [names.take(pa.array(used[w])) for w in p.words]
                    yield from dealt(lang, pc.binary_join_element_wise(*columns, " "), p.count, gram_hashes([hashes[w] for w in p.words]))

    return run


def _sum_parts(fields):
    """Sums the counts of each phrase of a part; holds the distinct phrases of its parts."""

    def run(batches):
        import pyarrow.compute as pc

        schema = _arrow(fields)
        held, rows = {}, 0

        def summed(tables):
            return pa.concat_tables(tables).group_by("phrase").aggregate([("f", "sum")]).rename_columns({"f_sum": "f"}).select(["phrase", "f"])

        for b in batches:
            for lang, part, phrases, counts in zip(*(c.to_pylist() for c in b.columns)):
                names = pc.split_pattern(pa.array([unpack(phrases).decode()]), "\n").flatten()
                new = pa.table({"phrase": names, "f": pa.array(np.frombuffer(unpack(counts), np.int64))})
                held.setdefault((lang, part), []).append(new)
                rows += new.num_rows
                if rows > HELD_PHRASES:
                    held, rows = {key: [summed(t)] for key, t in held.items()}, 0
        for (lang, _), tables in held.items():
            t = summed(tables)
            words = pc.if_else(pc.equal(t["phrase"], ""), 0, pc.add(pc.count_substring(t["phrase"], " "), 1)).cast(pa.int32())
            t = t.append_column("words", words).filter(pc.or_(pc.equal(words, 0), pc.greater_equal(t["f"], LEAST)))
            for some in t.to_batches(OUT_ROWS):
                yield _batch(schema, [pa.array([lang] * some.num_rows, pa.string()), some["words"], some["phrase"], some["f"]])

    return run


def frequent_phrases(docs: DataFrame) -> DataFrame:
    """(lang, words, phrase, f): every phrase of 2 to 4 words with f >= ``LEAST``, every word of these, and
    their exact counts; a row of 0 words has the count of all words. Materialised."""
    spark = docs.sparkSession
    ship_package(spark)
    schema = {text: spark.createDataFrame([], text).schema for text in (SHARDS, BLOCKS, PARTS, FOUND)}
    texts = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), F.coalesce("text", F.lit("")).alias("text"))
    written = materialize(texts.mapInArrow(_write_shards(schema[SHARDS]), schema[SHARDS]))
    shards = written.where("kind is null").select("lang", "words", "ids")
    frequent = Frequent()
    read_frequent(written.where("kind is not null").select("kind", "block", "counts"), [1, 2], frequent)
    counted = shards.mapInArrow(_count_longer(schema[BLOCKS], spark.sparkContext.broadcast(frequent)), schema[BLOCKS])
    read_frequent(counted, [NEEDED, 3, 4], frequent)
    bits = spark.sparkContext.broadcast(frequent)
    parts = part_count(frequent, spark.sparkContext.defaultParallelism)
    found = shards.mapInArrow(_phrases_of(schema[PARTS], bits, parts), schema[PARTS])
    return materialize(found.repartition("lang", "part").mapInArrow(_sum_parts(schema[FOUND]), schema[FOUND]))


def _part(start: Column, n: Column) -> Column:
    """``n`` words of the phrase from word ``start``."""
    return F.array_join(F.slice(F.split("phrase", " "), start, n), " ")


def collocations(docs: DataFrame, top: int = TOP) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's ``top`` phrases of 2 to 4 words by score.

    Defined cases: null text: empty; null lang: ``und``, one with a language of that name; null ids and
    repeated rows: every row counts; very long texts: split in blocks, whole; ties: by count, then
    phrase; empty table: no rows; other columns aren't read.
    """
    counted = frequent_phrases(docs)
    count_of = counted.where("words > 0").select("lang", "phrase", "f")
    many = counted.where("words > 1")

    inner = F.array(_part(F.lit(1), F.col("words") - 1), _part(F.lit(2), F.col("words") - 1))
    around = many.where("words > 2").select("lang", F.explode(inner).alias("phrase"), "f").groupBy("lang", "phrase").agg(F.max("f").alias("_around"))
    kept = many.join(around, ["lang", "phrase"], "left").where(f"_around is null or 100 * _around < {DROP_PERCENT} * f").drop("_around")

    cuts = kept.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("words") - 1))).withColumnRenamed("f", "a")
    cuts = cuts.withColumn("_left", _part(F.lit(1), F.col("k"))).withColumn("_right", _part(F.col("k") + 1, F.col("words") - F.col("k")))
    cuts = cuts.join(count_of.select("lang", F.col("phrase").alias("_left"), F.col("f").alias("l")), ["lang", "_left"])
    cuts = cuts.join(count_of.select("lang", F.col("phrase").alias("_right"), F.col("f").alias("r")), ["lang", "_right"])
    exact = F.col("a").cast("decimal(38,0)") * F.lit(SCALE).cast("decimal(38,0)")
    cuts = cuts.withColumn("score", F.call_function("div", exact, F.col("l").cast("decimal(38,0)") + F.col("r")))
    scored = cuts.groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("_cut")).select("lang", "phrase", "a", "_cut.l", "_cut.r", "_cut.score")

    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase").asc()]
    some = scored.withColumn("_group", F.pmod(F.xxhash64("phrase"), F.lit(RANK_GROUPS)))
    some = some.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "_group").orderBy(*order))).where(F.col("rank") <= top)
    first = some.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("bigint")).where(F.col("rank") <= top)
    totals = counted.where("words = 0").select("lang", F.col("f").alias("n"))
    return first.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


ORACLE_SQL = f"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS piece
  FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM pieces),
g AS (
  SELECT lang, s.k, array_to_string(w[i.i:i.i + s.k - 1], ' ') AS phrase
  FROM w, (SELECT unnest(range(1, {LONGEST + 1})) AS k) s, LATERAL (SELECT unnest(range(1, len(w) - s.k + 2)) AS i) i),
f AS (SELECT lang, k, phrase, count(*) AS f FROM g GROUP BY ALL),
n AS (SELECT lang, sum(f)::BIGINT AS n FROM f WHERE k = 1 GROUP BY lang),
c AS (SELECT lang, k, phrase, string_split(phrase, ' ') AS ws, f AS a FROM f WHERE k > 1 AND f >= {LEAST}),
inside AS (
  SELECT lang, array_to_string(ws[i.i:i.i + s.k - 1], ' ') AS phrase, max(a) AS around
  FROM c, (SELECT unnest(range(2, {LONGEST})) AS k) s, LATERAL (SELECT unnest(range(1, c.k - s.k + 2)) AS i) i
  WHERE s.k < c.k GROUP BY ALL),
kept AS (
  SELECT c.* FROM c LEFT JOIN inside i ON c.lang = i.lang AND c.phrase = i.phrase
  WHERE i.around IS NULL OR 100 * i.around < {DROP_PERCENT} * c.a),
cut AS (
  SELECT kept.*, s.k AS cut, array_to_string(ws[1:s.k], ' ') AS p, array_to_string(ws[s.k + 1:], ' ') AS q
  FROM kept, (SELECT unnest(range(1, {LONGEST})) AS k) s WHERE s.k < kept.k),
scored AS (
  SELECT cut.lang, cut.phrase, cut.a, cut.cut, x.f AS l, y.f AS r, (({SCALE}::HUGEINT * cut.a) // (x.f + y.f))::BIGINT AS score
  FROM cut JOIN f x ON x.lang = cut.lang AND x.phrase = cut.p JOIN f y ON y.lang = cut.lang AND y.phrase = cut.q),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM best)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN n USING (lang) WHERE rank <= {TOP}
"""
