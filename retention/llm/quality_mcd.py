"""Quality rules with robust multivariate outliers.

Each document's statistics are computed inside its row. Fixed rules fail very short and very
repetitive documents. The others are compared with the documents of their language and source: the
transformed statistics (``FEATURES``) of a group get a minimum-covariance-determinant estimate, and
a document whose squared Mahalanobis distance exceeds ``CUTOFF`` is rejected.

The estimate has three starts: coordinate-wise medians with interquartile ranges, the classical mean and
covariance, and the covariance of spatial signs about the medians. Each takes concentration steps over
all documents: distances, the share ``SUPPORT`` with the smallest ones, its mean and covariance, until the
determinant falls no more; the start with the lowest determinant gives the group's estimate. Floors
on the variances are part of the covariance everywhere, so a step can't raise its determinant: the chosen share
has at most the old mean squared distance, so the trace of the old inverse times the new covariance is
at most the number of features, and by the means' inequality the ratio of determinants at most 1.
Each step is a join with the groups' parameters and two
aggregates that combine before the shuffle, so a group may hold any share of the rows. Quantiles
come from counts of fixed-width bins, the same under any partitioning. Groups of fewer than
``MIN_GROUP`` documents are estimated together with the others of their language, and if these are
still too few, of all languages; where even these are fewer, nothing is rejected.

Defined cases: null text: no words (fails the rules); null language or source: a value of its own;
repeated rows count each; empty table: no rows; texts of any length are measured whole, in one row's arrays.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from retention.session import materialize, scratch_path

SYMBOLS = "#*$%&|<>"
BLANKS = " \t\n\x0b\x0c\r"
MIN_WORDS, MAX_REPEATED = 50, 50
#: Share of a group that determines its estimate, smallest group.
SUPPORT, MIN_GROUP = 0.75, 100
#: The logarithm of a determinant that falls by less than this has stopped falling.
SETTLED = 1e-4
#: Groups whose keys and estimates (a few hundred bytes each) are broadcast; more are joined by shuffle.
BROADCAST_GROUPS = 20_000
#: Standard deviations added to each feature's spread, so that a feature that is constant in most of a
#: group doesn't reject whatever differs from it a little.
FLOOR = {"x_words": 0.25, "x_length": 0.05, "x_symbols": 0.05, "x_repeats": 0.10, "x_lines": 0.10}
FEATURES = list(FLOOR)
#: Width of the bins in which a feature's quantiles are counted; of a log distance's.
BIN, LOG_BIN = 0.01, 0.02


def _chi2_cdf(x: float, k: float) -> float:
    """Regularised lower incomplete gamma function by its series."""
    a, x = k / 2, x / 2
    term = total = 1 / a
    n = a
    while term > total * 1e-15:
        n += 1
        term *= x / n
        total += term
    return total * math.exp(-x + a * math.log(x) - math.lgamma(a))


def _chi2_quantile(p: float, k: float) -> float:
    low, high = 1e-9, 1e3
    for _ in range(200):
        mid = (low + high) / 2
        low, high = (mid, high) if _chi2_cdf(mid, k) < p else (low, mid)
    return low


_P = len(FEATURES)
#: Makes the covariance of the inner share of a normal sample an estimate of the whole one's.
CONSISTENCY = SUPPORT / _chi2_cdf(_chi2_quantile(SUPPORT, _P), _P + 2)
#: Squared distance beyond which a document is rejected. A share's root deviates by 1 at most (repeated
#: words: 0.71, after the rules), so each feature's floor must stay below that by sqrt(CUTOFF), about 6,
#: for the feature to reject on its own.
CUTOFF = _chi2_quantile(1 - 1e-6, _P)


def statistics(docs: DataFrame) -> DataFrame:
    """(_doc, doc_id, lang, source, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines)
    of whole texts, in built-in functions; _doc is the row as it came."""
    text = F.coalesce(F.col("text"), F.lit(""))
    # hashes stand for the 3-word windows of a text: two of one text share a 64-bit hash by chance with a probability below 1e-9 up to a million words
    window = F.transform(F.sequence(F.lit(0), F.col("_n") - 3), lambda i: F.xxhash64(F.get("_w", i), F.get("_w", i + 1), F.get("_w", i + 2)))
    has_word = lambda line: F.length(F.translate(line, BLANKS, "")) > 0
    rows = docs.select(F.struct("*").alias("_doc"), "doc_id", "lang", "source", text.alias("_t"))
    rows = rows.select(
        "_doc", "doc_id", "lang", "source", F.length(F.translate("_t", BLANKS, "")).cast("bigint").alias("word_chars"),
        (F.length("_t") - F.length(F.translate("_t", SYMBOLS, ""))).cast("bigint").alias("n_symbols"),
        F.filter(F.split("_t", r"[\x20\x09-\x0D]+"), lambda w: w != "").alias("_w"), F.filter(F.split("_t", "\n"), has_word).alias("_l"),
    )
    rows = rows.withColumn("_n", F.size("_w"))
    rows = rows.select("_doc", "doc_id", "lang", "source", "word_chars", "n_symbols", F.col("_n"), F.size("_l").alias("_lines"), F.size(F.array_distinct("_l")).alias("_distinct"), F.when(F.col("_n") >= 3, window).otherwise(F.array().cast("array<bigint>")).alias("_h"))
    rows = rows.withColumn("_repeats", F.size(F.array_distinct("_h")) < F.size("_h"))
    return rows.select(
        "_doc", "doc_id", "lang", "source", F.col("_n").cast("bigint").alias("n_words"), "word_chars", "n_symbols", (F.col("_lines") - F.col("_distinct")).cast("bigint").alias("n_dup_lines"),
        F.when(F.col("_repeats"), _covered(F.col("_h"))).otherwise(0).cast("bigint").alias("n_repeat_words"), F.col("_lines").cast("bigint").alias("n_lines"),
    )


def _covered(hashes: Column) -> Column:
    """Words in windows of three that occur at least twice: windows sorted by hash, the places of those
    equal to a neighbour sorted, and the words that each adds to the one before."""
    by_hash = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    # lambda variables give names to the arrays, so that each is made once
    def places(s: Column) -> Column:
        found = F.filter(F.transform(s, lambda x, k: F.when((F.get(s, k - 1)["h"] == x["h"]) | (F.get(s, k + 1)["h"] == x["h"]), x["i"])), lambda i: i.isNotNull())
        return F.sort_array(found)

    def words(at: Column) -> Column:
        gaps = F.transform(at, lambda x, k: F.least(F.lit(3), F.coalesce(F.get(at, k + 1) - x, F.lit(3))))
        return F.aggregate(gaps, F.lit(0), lambda a, x: a + x)

    return F.get(F.transform(F.transform(F.array(by_hash), places), words), 0)


def features(stats: DataFrame) -> DataFrame:
    """Adds base_failed and the transformed statistics: logarithms of sizes, square roots of shares."""
    n = F.greatest(F.col("n_words"), F.lit(1)).cast("double")
    share = lambda part, whole: F.sqrt(F.col(part) / whole)
    return stats.withColumns({
        "base_failed": (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED * F.col("n_words")),
        "x_words": F.log(n), "x_length": F.log(F.greatest(F.col("word_chars"), F.lit(1)) / n),
        "x_symbols": share("n_symbols", F.greatest(F.col("word_chars"), F.lit(1)).cast("double")), "x_repeats": share("n_repeat_words", n),
        "x_lines": share("n_dup_lines", F.greatest(F.col("n_lines"), F.lit(1)).cast("double")),
    })


def _group_keys(rows: DataFrame) -> DataFrame:
    """(lang, source, _key): the group whose estimate is used; sizes count rows that pass the rules."""
    sized = rows.where(~F.col("base_failed")).groupBy("lang", "source").agg(F.count("*").alias("_n"))
    small = F.col("_n") < MIN_GROUP
    of_lang = sized.where(small).groupBy("lang").agg(F.sum("_n").alias("_pool"))
    name = lambda c: F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("-"))
    keyed = sized.alias("s").join(of_lang.alias("l"), F.col("s.lang").eqNullSafe(F.col("l.lang")), "left")
    key = F.when(~small, F.to_json(F.array(name("s.lang"), name("s.source")))).when(F.col("_pool") >= MIN_GROUP, F.to_json(F.array(name("s.lang")))).otherwise("[]")
    return keyed.select(F.col("s.lang").alias("_lang"), F.col("s.source").alias("_source"), key.alias("_key"))


#: Names of an estimate's columns: pairs of features of a covariance or its factor.
PAIRS = [(a, b) for i, a in enumerate(FEATURES) for b in FEATURES[:i + 1]]


def _quantiles(rows: DataFrame, value: Column, shares: list[float]) -> DataFrame:
    """(_key, _f, _q*, _in*, _all): bins of an integer column ``value`` in which the shares of rows end, the part
    of such a bin's rows that belongs to the share, and the number of rows."""
    binned = rows.groupBy("_key", "_f", value.alias("_bin")).agg(F.count("*").alias("_c"))
    of_key = Window.partitionBy("_key", "_f")
    run = F.sum("_c").over(of_key.orderBy("_bin").rowsBetween(Window.unboundedPreceding, 0))
    binned = binned.withColumns({"_run": run, "_all": F.sum("_c").over(of_key)})
    out = []
    for i, s in enumerate(shares):
        want = F.ceil(F.col("_all") * s)
        end = F.min(F.when(F.col("_run") >= want, F.struct("_bin", ((want - F.col("_run") + F.col("_c")) / F.col("_c")).alias("part"))))
        out.append(end.alias(f"_e{i}"))
    found = binned.groupBy("_key", "_f").agg(*out, F.max("_all").alias("_all"))
    return found.select("_key", "_f", *(x for i in range(len(shares)) for x in (F.col(f"_e{i}._bin").alias(f"_q{i}"), F.col(f"_e{i}.part").alias(f"_in{i}"))), "_all")


def _medians(rows: DataFrame) -> DataFrame:
    """The first start of each group: medians, and a diagonal from interquartile ranges."""
    stacked = rows.select("_key", F.explode(F.array(*(F.struct(F.lit(f).alias("_f"), F.round(F.col(f) / BIN).cast("bigint").alias("_b")) for f in FEATURES))).alias("_x")).select("_key", "_x._f", "_x._b")
    q = _quantiles(stacked, F.col("_b"), [0.25, 0.5, 0.75])
    one = q.groupBy("_key").agg(F.max("_all").alias("_n"), *(F.max(F.when(F.col("_f") == f, F.col("_q1") * BIN)).alias(f"m_{f}") for f in FEATURES), *(F.max(F.when(F.col("_f") == f, (F.col("_q2") - F.col("_q0")) * BIN / 1.349)).alias(f"s_{f}") for f in FEATURES))
    cov = {f"c_{a}_{b}": (F.pow(F.col(f"s_{a}"), 2) if a == b else F.lit(0.0)) for a, b in PAIRS}
    return _inverted(one.withColumns(cov).withColumn("_f", F.lit(0)))


def _starts(rows: DataFrame, medians: DataFrame) -> DataFrame:
    """All starts of each group: the medians' (0), the classical one (1), and spatial signs (2). ``medians`` is
    joined by group; both others come from one aggregate."""
    spread = {f: f"(1 / w_{f}_{f})" for f in FEATURES}
    away = rows.join(medians, "_key").withColumns({f"z_{f}": F.expr(f"({f} - m_{f}) * w_{f}_{f}") for f in FEATURES})
    away = away.withColumn("_far", F.expr("greatest(sqrt(" + " + ".join(f"z_{f} * z_{f}" for f in FEATURES) + "), 1e-9D)"))
    sums = away.groupBy("_key").agg(
        F.count("*").alias("_n"), *(F.avg(f).alias(f"a_{f}") for f in FEATURES), *(F.covar_pop(a, b).alias(f"c_{a}_{b}") for a, b in PAIRS),
        *(F.expr(f"avg(z_{a} * z_{b} / (_far * _far))").alias(f"u_{a}_{b}") for a, b in PAIRS),
        *(F.first(f"m_{f}").alias(f"m_{f}") for f in FEATURES), *(F.first(f"w_{f}_{f}").alias(f"w_{f}_{f}") for f in FEATURES),
    )
    classical = sums.select("_key", F.lit(1).alias("_f"), "_n", *(F.col(f"a_{f}").alias(f"m_{f}") for f in FEATURES), *(f"c_{a}_{b}" for a, b in PAIRS))
    signs = sums.select("_key", F.lit(2).alias("_f"), "_n", *(f"m_{f}" for f in FEATURES), *(F.expr(f"{len(FEATURES)} * u_{a}_{b} * {spread[a]} * {spread[b]}").alias(f"c_{a}_{b}") for a, b in PAIRS))
    return medians.unionByName(_inverted(classical.unionByName(signs)))


def _inverted(estimates: DataFrame) -> DataFrame:
    """(_key, _f, _n, m_*, w_*, _det): means, the inverse of the Cholesky factor of each covariance (c_*) with
    the floors on its diagonal, and the logarithm of its determinant."""
    # as SQL texts: a step for each entry, since each needs those before it
    out = estimates.withColumns({f"c_{f}_{f}": F.expr(f"c_{f}_{f} + {FLOOR[f] ** 2!r}D") for f in FEATURES})
    for i, a in enumerate(FEATURES):
        for j, b in enumerate(FEATURES[:i + 1]):
            rest = " - ".join([f"c_{a}_{b}", *(f"l_{a}_{k} * l_{b}_{k}" for k in FEATURES[:j])])
            out = out.withColumn(f"l_{a}_{b}", F.expr(f"sqrt({rest})" if i == j else f"({rest}) / l_{b}_{b}"))
    for j, b in enumerate(FEATURES):
        for i, a in enumerate(FEATURES[j:], j):
            total = " + ".join(f"l_{a}_{k} * w_{k}_{b}" for k in FEATURES[j:i])
            out = out.withColumn(f"w_{a}_{b}", F.expr(f"1 / l_{a}_{a}" if i == j else f"-({total}) / l_{a}_{a}"))
    det = F.expr("2 * (" + " + ".join(f"ln(l_{f}_{f})" for f in FEATURES) + ")")
    return out.select("_key", "_f", "_n", *(f"m_{f}" for f in FEATURES), *(f"w_{a}_{b}" for a, b in PAIRS), det.alias("_det"))


def _distances(rows: DataFrame, estimates: DataFrame, how: str = "inner") -> DataFrame:
    """Adds _d2, the squared Mahalanobis distance from the group's estimate (from each, if it has several)."""
    z = ["(" + " + ".join(f"w_{a}_{b} * ({b} - m_{b})" for b in FEATURES[:i + 1]) + ")" for i, a in enumerate(FEATURES)]
    return rows.join(estimates, "_key", how).withColumn("_d2", F.expr(" + ".join(f"power({x}, 2)" for x in z)))


def _concentrated(rows: DataFrame, estimates: DataFrame, few: bool = False) -> DataFrame:
    """The estimates from the share of each group that is nearest to the last ones; of the bin of distances in
    which the share ends, all rows count in part, so that the share is the same in each step. ``few``: the
    groups are few enough to broadcast, so that a large one isn't shuffled to one task."""
    near = _distances(rows, estimates).select("_key", "_f", *(F.expr(f"{f} - m_{f}").alias(f) for f in FEATURES), *(F.col(f"m_{f}") for f in FEATURES), F.floor(F.log(F.greatest("_d2", F.lit(1e-9))) / LOG_BIN).alias("_bin"))
    limit = _quantiles(near, F.col("_bin"), [SUPPORT]).select("_key", "_f", F.col("_q0").alias("_limit"), F.col("_in0").alias("_part"), F.col("_all").alias("_size"))
    inner = near.join(F.broadcast(limit) if few else limit, ["_key", "_f"]).where(F.col("_bin") <= F.col("_limit"))
    inner = inner.withColumn("_w", F.when(F.col("_bin") < F.col("_limit"), 1.0).otherwise(F.col("_part")))
    sums = inner.groupBy("_key", "_f").agg(
        F.max("_size").alias("_n"), F.sum("_w").alias("_h"), *(F.first(f"m_{f}").alias(f"m_{f}") for f in FEATURES),
        *(F.expr(f"sum(_w * {f})").alias(f"d_{f}") for f in FEATURES), *(F.expr(f"sum(_w * {a} * {b})").alias(f"s_{a}_{b}") for a, b in PAIRS),
    )
    moments = {f"c_{a}_{b}": F.expr(f"{CONSISTENCY!r}D * (s_{a}_{b} / _h - d_{a} / _h * (d_{b} / _h))") for a, b in PAIRS}
    return _inverted(sums.withColumns(moments).withColumns({f"m_{f}": F.expr(f"m_{f} + d_{f} / _h") for f in FEATURES}))


def estimated(rows: DataFrame, few: bool) -> DataFrame:
    """(_key, _n, m_*, w_*, _det): each group's minimum-covariance-determinant estimate, of rows (_key and features).
    Steps go on for the starts whose determinant still falls; a determinant is bounded by the floors
    below and falls by ``SETTLED`` at least, so they end."""

    def at_hand(groups: DataFrame) -> DataFrame:
        return F.broadcast(groups) if few else groups

    starts = materialize(_starts(rows, at_hand(materialize(_medians(rows)))))
    # a start's covariance isn't one of a share of the rows, so its determinant doesn't count
    last = materialize(_concentrated(rows, at_hand(starts), few))
    settled = last.limit(0)
    while not last.isEmpty():
        new = materialize(_concentrated(rows, at_hand(last), few))  # a filter on _det would be pushed into its long expression
        new = new.join(last.select("_key", "_f", F.col("_det").alias("_before")), ["_key", "_f"])
        new = materialize(new.where(F.col("_det") < F.col("_before") - SETTLED).drop("_before"))
        settled = settled.unionByName(last.join(new.select("_key", "_f"), ["_key", "_f"], "left_anti"))
        last = new
    names = [c for c in settled.columns if c not in ("_key", "_f")]
    best = settled.groupBy("_key").agg(F.min_by(F.struct(*names), F.struct("_det", "_f")).alias("_best"))
    return materialize(best.select("_key", "_best.*"))


def judged(docs: DataFrame, carry: bool = False) -> DataFrame:
    """A row per document: its statistics, base_failed, kept, and the squared distance (null where the
    rules failed it or its group is too small); with ``carry`` also _doc, the row as it came."""
    rows = features(statistics(docs))
    if carry:
        path = scratch_path(docs.sparkSession, "quality")
        rows.write.option("compression", "zstd").parquet(path)
        rows = docs.sparkSession.read.parquet(path)
    else:
        rows = materialize(rows.drop("_doc"))
    keys = materialize(_group_keys(rows))
    few = keys.count() <= BROADCAST_GROUPS

    def at_hand(groups: DataFrame) -> DataFrame:
        """Broadcast if the groups are few, else left to a shuffled join, whose skew Spark splits."""
        return F.broadcast(groups) if few else groups

    keys = at_hand(keys)
    keyed = rows.alias("r").join(keys, F.col("r.lang").eqNullSafe(F.col("_lang")) & F.col("r.source").eqNullSafe(F.col("_source")), "left").select("r.*", "_key")
    passed = keyed.where(~F.col("base_failed")).select("_key", *FEATURES)
    estimates = estimated(passed, few)
    scored = _distances(keyed, at_hand(estimates), "left")
    far = F.when(~F.col("base_failed") & (F.col("_n") >= MIN_GROUP), F.col("_d2"))
    return scored.withColumn("distance", far).withColumn("kept", ~F.col("base_failed") & (F.coalesce("distance", F.lit(0.0)) <= CUTOFF))


def quality_rows(docs: DataFrame) -> DataFrame:
    return judged(docs.select("doc_id", "text", "lang", "source")).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "distance")


def kept_documents(docs: DataFrame) -> DataFrame:
    """The documents that the rules and estimates keep, columns as they came. The texts aren't shuffled:
    groups' estimates come to them."""
    return judged(docs, carry=True).where("kept").select(*(F.col("_doc").getField(c).alias(c) for c in docs.columns))
