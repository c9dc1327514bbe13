"""Language-model scores of whole documents by a gated recurrent network.

The output is factored by classes: the network gives the probability of a word's class from the
classes before it (state carried through the whole document), and a word's probability within its
class comes from counts over all training documents. Frequent words (at most ``TABLE``, seen twice
or more) are split by the language in whose documents they mostly stand and by bands of equal token
mass; one class holds the end of a document and one all other words, known and unknown. In that class
known words have discounted counts, and the discounts' mass is the unknown word's.

1. Words are counted over all training documents: in each task, then combined by word.
2. One pass over all documents finds each token's class and the sums of the count scores. The table of
   frequent words has a fixed bound and is broadcast; other words leave the pass as (row, word, times)
   and meet their counts in a join.
3. The network is trained on the classes of all training documents. A hash of a document and its classes deals it to
   one of about tokens / ``SHARD_TOKENS`` shards (at least ``ROUNDS``), equal rows in turn from there on. The shards
   go through ``ROUNDS`` rounds, one more for each doubling of their number: each shard takes the last round's
   parameters through its documents (truncated backpropagation), and the shards' parameters are
   averaged by their tokens, an aggregate of exact sums over parameter numbers. So files, splits and tasks
   don't change the model; scores of other partitionings differ by float rounding only.
4. It scores the classes of all documents.

Defined cases: null text: empty, so only the end is scored; null doc_id: remainder of the empty text,
0; no training documents: both scores are those of uniform counts; repeated rows: scored each; empty
table: no rows. Very long texts are read in blocks; long documents slow their own lane only.
"""

from __future__ import annotations

import math
import uuid
from collections import Counter
from itertools import groupby, repeat

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retention.llm import gru
from retention.llm.common import map_rows, texts_of
from retention.llm.simhash import word_blocks
from retention.session import scratch_path

#: Bound of the broadcast table, languages told apart, bands of a language's words.
TABLE, LANGUAGES, BANDS = 1 << 17, 7, 8
HIDDEN, ROUNDS, RATE = 24, 3, 0.02
#: Code points of the documents that run through the network together; distinct words a task holds.
GROUP_CHARS, HELD_WORDS = 6_000_000, 400_000
#: Tokens of a shard of the training documents, which one step of a round takes a model through.
SHARD_TOKENS = 1 << 20
#: Parameters times tokens are added as integers of this fraction, so that a sum has no order.
FRACTION = float(1 << 40)
#: Bins of a doubling in which words are counted by their count.
COUNT_BINS = 32
END, RARE = 0, 1


def split_remainder(docs: DataFrame) -> DataFrame:
    """(doc_id, text, lang, part): part is crc32(doc_id as text) mod 5; documents of part 1 are held out."""
    lang = F.coalesce(F.col("lang").cast("string"), F.lit("")) if "lang" in docs.columns else F.lit("")
    part = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 5
    return docs.select(F.col("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"), lang.alias("lang"), part.cast("int").alias("part"))


def words_of(text: str):
    return word_blocks(text.encode().lower())


def count_words(training: DataFrame, languages: list[str]) -> DataFrame:
    """(word, c, g): counts over all training documents, and the group of languages with most of them."""
    number = {lang: i for i, lang in enumerate(languages)}

    def rows(source):
        held: dict[int, Counter] = {}
        for r in source:
            c = held.setdefault(number.get(r["lang"], len(number)), Counter())
            for words in words_of(r["text"]):
                c.update(words)
                if sum(map(len, held.values())) > HELD_WORDS:
                    yield from flushed(held)
        yield from flushed(held)

    def flushed(held):
        for g, c in held.items():
            for w, n in c.items():
                yield w.decode(), g, n
            c.clear()

    parts = map_rows(training.select("text", "lang"), rows, "word string, g int, n bigint")
    by_group = parts.groupBy("word", "g").agg(F.sum("n").alias("n"))
    return by_group.groupBy("word").agg(F.sum("n").alias("c"), F.max_by("g", F.struct("n", "g")).alias("g"))


class Vocabulary:
    """The broadcast part: frequent words with their classes and log10 probabilities."""

    def __init__(self, rows: list[tuple[str, int, int]], tokens: int, types: int, ends: int):
        self.key = uuid.uuid4().hex
        rows = sorted(rows, key=lambda r: (r[2], -r[1], r[0]))
        self.words = [r[0].encode() for r in rows]
        count = np.array([r[1] for r in rows], np.float64)
        group = np.array([r[2] for r in rows], np.int64)
        self.klass = np.zeros(len(rows) + 2, np.int64)
        n = 2
        for g in np.unique(group):
            own = np.flatnonzero(group == g)  # by falling counts
            mass = np.cumsum(count[own]) / count[own].sum()
            band = np.minimum((mass - count[own] / count[own].sum() / 2) * BANDS, BANDS - 1).astype(np.int64)
            _, band = np.unique(band, return_inverse=True)
            self.klass[own] = n + band
            n += int(band.max()) + 1
        # the last two entries: the end of a document, and any other word
        self.klass[-2:] = END, RARE
        self.classes, self.tokens, self.types = n, tokens, types
        sums, sizes = np.bincount(self.klass[:-2], count, n), np.bincount(self.klass[:-2], minlength=n)
        self.within = np.zeros(len(rows) + 2)
        self.within[:-2] = np.log10((count + 0.5) / (sums + 0.5 * sizes)[self.klass[:-2]])
        self.base = np.zeros(len(rows) + 2)
        self.base[:-1] = np.log10((np.append(count, ends) + 0.5) / (tokens + 0.5 * (types + 1)))
        sums[END], sums[RARE] = ends, max(0, tokens - ends - count.sum())
        self.bias = np.log((sums + 0.5) / (sums + 0.5).sum())
        self.ends = ends


_INDEX: dict[str, dict[bytes, int]] = {}


def _index(v: Vocabulary) -> dict[bytes, int]:
    """A worker's index of the broadcast words."""
    if v.key not in _INDEX:
        _INDEX.clear()
        _INDEX[v.key] = {w: i for i, w in enumerate(v.words)}
    return _INDEX[v.key]


def _encoded(v: Vocabulary, text: str) -> tuple[np.ndarray, Counter]:
    """Numbers of a document's tokens in the vocabulary, and its words that aren't there."""
    index, other = _index(v), len(v.words) + 1
    out, rare = [], Counter()
    for words in words_of(text):
        ids = np.fromiter(map(index.get, words, repeat(other)), np.int64, len(words))
        out.append(ids)
        rare.update([words[i] for i in np.flatnonzero(ids == other).tolist()])
    return np.concatenate([*out, [len(v.words)]]).astype(np.int64), rare


def _groups(source):
    held, size = [], 0
    for r in source:
        held.append(r)
        size += r["chars"] + 1000
        if size >= GROUP_CHARS:
            yield held
            held, size = [], 0
    if held:
        yield held


def _classes(kept: bytes) -> np.ndarray:
    """A document's classes as the first pass wrote them: there are at most BANDS for each of LANGUAGES + 1
    groups, and two, so a byte holds one."""
    return np.frombuffer(kept, np.uint8).astype(np.int64)


def shard_numbers(tokens: int) -> tuple[int, int]:
    """(shards, rounds) for a corpus of so many training tokens."""
    shards = max(ROUNDS, -(-tokens // SHARD_TOKENS))
    return shards, ROUNDS + (shards // ROUNDS).bit_length() - 1


def sharded(training: DataFrame, shards: int) -> DataFrame:
    """(shard, place, doc_id, classes, times): equal rows are counted first, then spread over the shards."""
    one = training.groupBy("doc_id", "classes").agg(F.count("*").alias("n"))
    place = F.xxhash64("doc_id", "classes")
    step = F.explode(F.sequence(F.lit(0), F.least(F.col("n"), F.lit(shards)).cast("int") - 1))
    dealt = one.withColumns({"place": place, "j": step})
    times = F.floor(F.col("n") / shards) + (F.col("j") < F.col("n") % shards).cast("int")
    shard = F.pmod(F.pmod("place", F.lit(shards)) + F.col("j"), F.lit(shards))
    return dealt.select(shard.alias("shard"), "place", "doc_id", "classes", times.cast("int").alias("times"))


def _through(start: np.ndarray, like: dict[str, np.ndarray], rate: float):
    """The pass of a model over each shard, which gives (i, x, n): parameter i afterwards, and the shard's tokens."""

    def rows(source):
        for _, shard in groupby(source, key=lambda r: r["shard"]):
            sequences = [x for r in shard for x in [_classes(r["classes"])] * r["times"]]
            adam = gru.Adam(gru.shaped(start, like), rate)
            gru.train(adam, sequences, END)
            n = sum(map(len, sequences))
            yield from ((i, x, n) for i, x in enumerate(gru.flat(adam.p).tolist()))

    return rows


def train(training: DataFrame, like: dict[str, np.ndarray], tokens: int) -> np.ndarray:
    """Parameters averaged over the shards, round by round; every training document is used once."""
    spark = training.sparkSession
    shards, rounds = shard_numbers(tokens)
    path = scratch_path(spark, "lm-shards")
    sharded(training, shards).write.parquet(path)
    kept = spark.read.parquet(path)
    values = gru.flat(like)
    for k in range(rounds):
        own = kept.where(F.pmod("shard", F.lit(rounds)) == k).repartition("shard").sortWithinPartitions("shard", "place", "doc_id")
        moved = map_rows(own, _through(values, like, RATE / (1 + k)), "i int, x double, n bigint")
        exact = F.sum((F.col("x") * F.col("n") * FRACTION).cast("decimal(38,0)"))
        got = moved.groupBy("i").agg(exact.alias("x"), F.sum("n").alias("n")).collect()  # one row per parameter
        if got:
            values = np.zeros(len(values))
            for r in got:
                values[r["i"]] = float(r["x"]) / FRACTION / r["n"]
    return values


def score_documents(docs: DataFrame) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of all documents."""
    spark = docs.sparkSession
    rows_in = split_remainder(docs)
    training = rows_in.where("part <> 1")
    by_lang = training.groupBy("lang").agg(F.count("*").alias("n"))
    languages = [r["lang"] for r in by_lang.orderBy(F.desc("n"), "lang").limit(LANGUAGES).collect()]
    ends = by_lang.agg(F.sum("n")).first()[0] or 0

    path = scratch_path(spark, "lm-counts")
    count_words(training, languages).write.parquet(path)
    counts = spark.read.parquet(path)
    total = counts.agg(F.sum("c"), F.count("*"), F.sum(F.when(F.col("c") == 1, 1)), F.sum(F.when(F.col("c") == 2, 1))).first()
    tokens, types = (total[0] or 0) + ends, total[1] + (ends > 0)
    once, twice = total[2] or 0, total[3] or 0
    bin_ = F.floor(F.log2(F.col("c").cast("double")) * COUNT_BINS)
    room, least = TABLE, COUNT_BINS
    bins = sorted(((r["b"], r["n"]) for r in counts.where("c > 1").groupBy(bin_.alias("b")).agg(F.count("*").alias("n")).collect()), reverse=True)  # at most 63 x COUNT_BINS
    for b, n in bins:
        if n > room:
            least = b + 1
            break
        room -= n
    frequent = [(r["word"], r["c"], r["g"]) for r in counts.where((F.col("c") > 1) & (bin_ >= least)).collect()]  # at most TABLE rows
    v = Vocabulary(frequent, tokens, types, ends)
    vocabulary = spark.sparkContext.broadcast(v)
    rare_types, rare_tokens = types - (ends > 0) - len(frequent), tokens - ends - sum(c for _, c, _ in frequent)
    discount = once / (once + 2 * twice) if once + twice else 0.5
    discount = min(max(discount, 0.05), 0.95)

    def rows(source):
        v = vocabulary.value
        for r in source:
            ids, rare = _encoded(v, r["text"])
            known = len(ids) - sum(rare.values()) - (v.ends == 0)
            classes = v.klass[ids].astype(np.uint8).tobytes()
            yield r["_rk"], r["doc_id"], r["part"], len(ids), known, float(v.base[ids].sum()), float(v.within[ids].sum()), classes, len(r["text"]), None, None
            for w, n in rare.items():
                yield r["_rk"], None, None, 0, 0, 0.0, 0.0, None, None, w.decode(), n

    passed = map_rows(rows_in.select("doc_id", "text", "part", F.monotonically_increasing_id().alias("_rk")), rows, "_rk bigint, doc_id bigint, part int, n_tokens bigint, n_known bigint, base_score double, score double, classes binary, chars bigint, word string, times bigint")
    path = scratch_path(spark, "lm-pass")
    passed.write.parquet(path)
    passed = spark.read.parquet(path)
    encoded = passed.where("word is null")

    like = gru.fresh(v.classes, HIDDEN, v.bias)
    params = gru.shaped(train(encoded.where("part <> 1"), like, tokens), like)

    def scores(source):
        for group in _groups(source):
            found = gru.log10_likelihood(params, [_classes(r["classes"]) for r in group], END)
            for r, score in zip(group, found.tolist()):
                yield r["_rk"], r["doc_id"], r["part"] == 1, r["n_tokens"], r["n_known"], r["base_score"], r["score"] + score

    scored = map_rows(encoded.drop("word", "times"), scores, "_rk bigint, doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, base_score double, score double")
    met = passed.where("word is not null").select("_rk", "word", "times").join(counts.select("word", "c"), "word", "left")
    c, times = F.coalesce("c", F.lit(0)), F.col("times")
    base = times * F.log10((c + 0.5) / (tokens + 0.5 * (types + 1)))
    if rare_types:
        within = F.when(c > 0, F.log10((c - discount) / float(rare_tokens))).otherwise(F.lit(math.log10(discount * rare_types / rare_tokens)))
    else:
        within = F.lit(0.0)
    none = lambda kind: F.lit(None).cast(kind)
    more = met.select("_rk", none("bigint").alias("doc_id"), none("boolean").alias("held_out"), F.lit(0).cast("bigint").alias("n_tokens"), F.when(c > 0, times).otherwise(0).alias("n_known"), base.alias("base_score"), (times * within).alias("score"))
    both = scored.unionByName(more)
    summed = both.groupBy("_rk").agg(F.max("doc_id").alias("doc_id"), F.max("held_out").alias("held_out"), *(F.sum(x).alias(x) for x in ("n_tokens", "n_known", "base_score", "score")))
    return summed.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(tokens).cast("bigint").alias("train_tokens"), "base_score", "score")
