"""Exact ranking metrics without a single-partition window.

Everything is derived from one *score curve*: rows grouped by distinct score
(partial aggregation, so a score shared by a third of the rows is still one
row), with the positives and negatives strictly above each score.

The "strictly above" prefix sums are computed in two levels:
  1. distinct scores are cut into ``buckets`` ranges by approximate quantiles
     (one aggregate job; the bounds are a bounded list);
  2. bucket totals (at most ``buckets`` rows) give each bucket's offset, and a
     window partitioned *by bucket* gives the running sum inside it.
No step puts the whole table in one task; the only global windows run over
at most ``buckets`` rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

DEFAULT_BUCKETS = 256
# Distinct scores per bucket the within-bucket window should see, and the most
# buckets we allow (the bucket table is broadcast, so its size must stay bounded).
SCORES_PER_BUCKET = 1_000_000
MAX_BUCKETS = 100_000


def bucket_count(n_scores: int, minimum: int = DEFAULT_BUCKETS) -> int:
    """Buckets for ``n_scores`` distinct scores: at least ``minimum``, about
    ``SCORES_PER_BUCKET`` scores each, never more than ``MAX_BUCKETS``."""
    need = -(-n_scores // SCORES_PER_BUCKET)
    return max(1, min(MAX_BUCKETS, max(minimum, need)))


def _quantile_bounds(df: DataFrame, score: str, buckets: int, with_count: bool = False):
    """Approximate quantile bounds for ``buckets`` buckets (and optionally the row
    count) in one aggregate job; one small row comes back."""
    probs = [i / buckets for i in range(1, buckets)]
    acc = max(10_000, 4 * buckets)
    aggs = [F.percentile_approx(score, probs, acc).alias("q")] if buckets > 1 else [F.lit(None).alias("q")]
    if with_count:
        aggs.append(F.count(F.lit(1)).alias("n"))
    row = df.agg(*aggs).first()
    bounds = sorted(set(v for v in (row.q or []) if v is not None))
    return bounds, (int(row.n) if with_count else None)


def _with_bucket(df: DataFrame, score: str, bounds: list[float]) -> DataFrame:
    """Add ``_b`` (0 = lowest scores): a ``Bucketizer`` binary search over the bounds."""
    if not bounds:
        return df.withColumn("_b", F.lit(0))
    from pyspark.ml.feature import Bucketizer
    splits = [float("-inf")] + [float(b) for b in bounds] + [float("inf")]
    bz = Bucketizer(splits=splits, inputCol=score, outputCol="_bd", handleInvalid="keep")
    return bz.transform(df).withColumn("_b", F.col("_bd").cast("int")).drop("_bd")


def score_groups(scored: DataFrame, score: str = "churn_probability", label: str = "churn_label",
                 extra: tuple[str, ...] = (), materialize: bool = True) -> DataFrame:
    """Positives and negatives per distinct score (and ``extra`` keys), checkpointed.

    Partial aggregation before the shuffle keeps a heavily repeated score cheap.
    The result is written to the shared checkpoint folder so the quantile job
    and the main plan both read it instead of recomputing the scoring plan.
    """
    y = F.col(label).cast("int")
    # Rows without a score stay a group of their own: curves leave it out, counts don't.
    g = scored.groupBy(F.col(score).alias("score"), *extra).agg(
        F.sum(y).cast("bigint").alias("pos"), F.sum(1 - y).cast("bigint").alias("neg"))
    if materialize:
        from retention.session import materialize as _m
        g = _m(g)
    return g


def score_curve(scored: DataFrame, score: str = "churn_probability", label: str = "churn_label",
                buckets: int | None = None, groups: DataFrame | None = None) -> DataFrame:
    """One row per distinct score: ``pos, neg, pos_above, neg_above`` (strictly higher scores)
    plus the totals ``P, N``. ``groups`` may pass a ready ``score_groups`` table;
    ``buckets=None`` sizes the buckets from the number of distinct scores."""
    g = score_groups(scored, score, label) if groups is None else groups
    g = g.filter(F.col("score").isNotNull())
    if set(g.columns) != {"score", "pos", "neg"}:
        g = g.groupBy("score").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    if buckets is None:
        # Bounds for the default bucket count and the distinct-score count in one job
        # (over the checkpointed groups); a second job only when the data needs more.
        bounds, n = _quantile_bounds(g, "score", DEFAULT_BUCKETS, with_count=True)
        need = bucket_count(n)
        if need > DEFAULT_BUCKETS:
            bounds, _ = _quantile_bounds(g, "score", need)
    else:
        bounds, _ = _quantile_bounds(g, "score", buckets)
    g = _with_bucket(g, "score", bounds)
    tot = g.groupBy("_b").agg(F.sum("pos").alias("_bp"), F.sum("neg").alias("_bn"))
    above = Window.orderBy(F.col("_b").desc()).rowsBetween(Window.unboundedPreceding, -1)
    all_rows = Window.partitionBy(F.lit(1))
    tot = tot.select(
        "_b",
        F.coalesce(F.sum("_bp").over(above), F.lit(0)).alias("_op"),
        F.coalesce(F.sum("_bn").over(above), F.lit(0)).alias("_on"),
        F.sum("_bp").over(all_rows).alias("P"),
        F.sum("_bn").over(all_rows).alias("N"))
    inb = Window.partitionBy("_b").orderBy(F.col("score").desc()).rowsBetween(Window.unboundedPreceding, -1)
    g = g.select("score", "pos", "neg", "_b",
                 F.coalesce(F.sum("pos").over(inb), F.lit(0)).alias("_ip"),
                 F.coalesce(F.sum("neg").over(inb), F.lit(0)).alias("_in"))
    # ``tot`` has at most ``buckets`` rows: a bounded broadcast.
    j = g.join(F.broadcast(tot), "_b")
    return j.select("score", "pos", "neg",
                    (F.col("_op") + F.col("_ip")).cast("bigint").alias("pos_above"),
                    (F.col("_on") + F.col("_in")).cast("bigint").alias("neg_above"),
                    F.col("P").cast("bigint").alias("P"), F.col("N").cast("bigint").alias("N"))


def auc(curve: DataFrame) -> DataFrame:
    """M6: ROC AUC with half credit for ties: sum pos * (neg below + neg/2) / (P * N)."""
    below = F.col("N") - F.col("neg_above") - F.col("neg")
    num = F.sum(F.col("pos").cast("double") * (below.cast("double") + F.col("neg").cast("double") * 0.5))
    a = curve.agg(num.alias("_num"), F.max("P").alias("P"), F.max("N").alias("N"))
    den = F.col("P").cast("double") * F.col("N").cast("double")
    return a.select(F.when(den > 0, F.col("_num") / den).alias("auc"))


def roc_curve(curve: DataFrame) -> DataFrame:
    """One point per distinct threshold (score >= threshold predicts churn)."""
    tps = F.col("pos_above") + F.col("pos")
    fps = F.col("neg_above") + F.col("neg")
    return curve.select(
        F.col("score").alias("threshold"),
        tps.alias("tps"), fps.alias("fps"),
        F.when(F.col("P") > 0, tps / F.col("P")).otherwise(F.lit(0.0)).alias("tpr"),
        F.when(F.col("N") > 0, fps / F.col("N")).otherwise(F.lit(0.0)).alias("fpr"),
        F.when(tps + fps > 0, tps / (tps + fps)).otherwise(F.lit(0.0)).alias("precision"))


def precision_at_recall(curve: DataFrame, target_recall: float) -> DataFrame:
    """M8: precision at the curve point whose recall is nearest ``target_recall``.

    Points: every distinct threshold, plus the end point (recall 0, precision 1)
    placed above every threshold. Ties go to the lowest threshold. The pick is
    a distributed top-1 (``orderBy().limit(1)``).
    """
    tps = F.col("pos_above") + F.col("pos")
    fps = F.col("neg_above") + F.col("neg")
    recall = F.when(F.col("P") > 0, tps / F.col("P")).otherwise(F.lit(1.0))
    prec = F.when(tps + fps > 0, tps / (tps + fps)).otherwise(F.lit(0.0))
    pts = curve.select(F.lit(0).alias("_end"), F.col("score").alias("threshold"),
                       recall.alias("recall"), prec.alias("precision"))
    spark = curve.sparkSession
    end = spark.createDataFrame([(1, None, 0.0, 1.0)],
                                "_end int, threshold double, recall double, precision double")
    allp = pts.unionByName(end)
    dist = F.abs(F.col("recall") - F.lit(float(target_recall)))
    best = allp.orderBy(dist.asc(), F.col("_end").asc(), F.col("threshold").asc()).limit(1)
    return best.select(F.col("precision").alias("precision_at_target_recall"),
                       F.col("recall").alias("recall_at_pick"), "threshold")


def prf(scored: DataFrame, label: str = "churn_label", pred: str = "churn_prediction") -> DataFrame:
    """M7: precision, recall, F1 of the 0/1 predictions; 0 where undefined."""
    y, yh = F.col(label) == 1, F.coalesce(F.col(pred) == 1, F.lit(False))
    a = scored.agg(F.count_if(y & yh).alias("tp"), F.count_if(~y & yh).alias("fp"),
                   F.count_if(y & ~yh).alias("fn"), F.count(F.lit(1)).alias("n_rows"))
    return _prf_select(a)


def _prf_select(a: DataFrame) -> DataFrame:
    p = F.when(F.col("tp") + F.col("fp") > 0, F.col("tp") / (F.col("tp") + F.col("fp"))).otherwise(F.lit(0.0))
    r = F.when(F.col("tp") + F.col("fn") > 0, F.col("tp") / (F.col("tp") + F.col("fn"))).otherwise(F.lit(0.0))
    f1 = F.when(2 * F.col("tp") + F.col("fp") + F.col("fn") > 0,
                2 * F.col("tp") / (2 * F.col("tp") + F.col("fp") + F.col("fn"))).otherwise(F.lit(0.0))
    return a.select("n_rows", "tp", "fp", "fn", p.alias("precision"), r.alias("recall"), f1.alias("f1"))


def prf_from_groups(groups: DataFrame, pred: str = "churn_prediction") -> DataFrame:
    """M7 from the (score, prediction) groups, no second pass over the rows."""
    yh = F.coalesce(F.col(pred) == 1, F.lit(False))
    a = groups.agg(F.coalesce(F.sum(F.when(yh, F.col("pos"))), F.lit(0)).alias("tp"),
                   F.coalesce(F.sum(F.when(yh, F.col("neg"))), F.lit(0)).alias("fp"),
                   F.coalesce(F.sum(F.when(~yh, F.col("pos"))), F.lit(0)).alias("fn"),
                   F.coalesce(F.sum(F.col("pos") + F.col("neg")), F.lit(0)).alias("n_rows"))
    return _prf_select(a)


def metrics(scored: DataFrame, target_recall: float, label: str = "churn_label",
            score: str = "churn_probability", pred: str = "churn_prediction",
            buckets: int | None = None) -> DataFrame:
    """M9: one row with n_rows, n_unscored, auc, precision, recall, f1, precision_at_target_recall.

    Rows without a score count as not predicted in precision, recall and F1, and are
    counted in n_unscored; they have no place on the curve.

    The three one-row results are stacked as (metric, value) rows and pivoted
    back into one row, so no join is needed to put them side by side.
    """
    groups = score_groups(scored, score, label, extra=(pred,))
    curve = score_curve(scored, score, label, buckets, groups=groups)
    names = ["n_rows", "n_unscored", "auc", "precision", "recall", "f1", "precision_at_target_recall"]

    def long(df: DataFrame, cols: list[str]) -> DataFrame:
        return df.select(F.inline(F.array(*[
            F.struct(F.lit(c).alias("metric"), F.col(c).cast("double").alias("value")) for c in cols])))

    stacked = (long(prf_from_groups(groups, pred), ["n_rows", "precision", "recall", "f1"])
               .unionByName(long(groups.filter(F.col("score").isNull()).agg(
                   F.coalesce(F.sum(F.col("pos") + F.col("neg")), F.lit(0)).alias("n_unscored")), ["n_unscored"]))
               .unionByName(long(auc(curve), ["auc"]))
               .unionByName(long(precision_at_recall(curve, target_recall), ["precision_at_target_recall"])))
    wide = stacked.groupBy().pivot("metric", names).agg(F.first("value"))
    counts = [F.col(c).cast("bigint").alias(c) for c in names[:2]]
    return wide.select(*counts, *names[2:])


def threshold_gate(metrics_row: DataFrame, min_auc: float, min_precision: float) -> DataFrame:
    """One row per gated metric with its threshold and warn/ok; error if rows have no score."""
    rows = F.array(
        F.struct(F.lit("auc").alias("metric"), F.col("auc").alias("value"), F.lit(float(min_auc)).alias("minimum")),
        F.struct(F.lit("precision_at_target_recall").alias("metric"),
                 F.col("precision_at_target_recall").alias("value"), F.lit(float(min_precision)).alias("minimum")))
    unscored = (F.col("n_unscored") > 0).alias("_unscored")
    out = metrics_row.select(unscored, F.inline(rows))
    status = F.when(F.col("_unscored"), "error").when(F.col("value") < F.col("minimum"), "warn").otherwise("ok")
    return out.withColumn("status", status).drop("_unscored")


def lift_deciles(curve: DataFrame) -> DataFrame:
    """P4 lift table: rows ranked by score (ties kept together), cut in tenths by the
    position of the first row of each score; churn rate and lift per decile."""
    total = F.col("P") + F.col("N")
    above = F.col("pos_above") + F.col("neg_above")
    dec = F.floor(F.lit(10) * above / total).cast("int") + 1
    d = curve.filter(total > 0).select(dec.alias("decile"), "pos", "neg", "P", "N")
    g = d.groupBy("decile").agg(F.sum(F.col("pos") + F.col("neg")).alias("customers"),
                                F.sum("pos").alias("churners"), F.max("P").alias("P"), F.max("N").alias("N"))
    rate = F.col("churners") / F.col("customers")
    base = F.col("P") / (F.col("P") + F.col("N"))
    return g.select("decile", "customers", "churners", rate.alias("churn_rate"),
                    F.when(base > 0, rate / base).otherwise(F.lit(0.0)).alias("lift"))
