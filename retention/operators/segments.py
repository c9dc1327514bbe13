"""Second-tier analytics the reference declares.

Lags and rolling statistics use windows partitioned by customer and ordered by
snapshot date: a partition holds one customer's snapshots (bounded by the
number of snapshot dates, not by the customer's activity).
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from retention.functions.timewin import days_ago, lookback

# Seasonal period (days) and harmonics of the Fourier features.
FOURIER_PERIOD = 7
FOURIER_HARMONICS = (1, 2)


def lag_rolling(features: DataFrame, column: str = "txn_count_30d", window: int = 4) -> DataFrame:
    """P1 + P2: previous value, change, and rolling mean / sample std over the last
    ``window`` snapshots of each customer."""
    w = Window.partitionBy("customer_id").orderBy("snapshot_date")
    roll = w.rowsBetween(-(window - 1), 0)
    x = F.col(column)
    return features.select(
        "customer_id", "snapshot_date", x.alias("value"),
        F.lag(x).over(w).alias("lag_1"),
        (x - F.lag(x).over(w)).alias("delta_1"),
        F.avg(x).over(roll).alias(f"rolling_mean_{window}"),
        F.stddev_samp(x).over(roll).alias(f"rolling_std_{window}"))


def fourier_features(transactions: DataFrame, snapshot: str, window_days: int = 90,
                     period: int = FOURIER_PERIOD, harmonics: tuple[int, ...] = FOURIER_HARMONICS) -> DataFrame:
    """Per customer, sum over lookback transactions of cos / sin(2 pi k t / period),
    t = days before the snapshot (reduced mod period so every engine sees the same angles)."""
    t = (days_ago(snapshot, F.col("timestamp")) % period).cast("double")
    aggs = [F.count(F.lit(1)).alias("txn_rows")]
    for k in harmonics:
        ang = F.lit(2.0 * math.pi * k) * t / F.lit(float(period))
        aggs += [F.sum(F.cos(ang)).alias(f"fourier_cos_{k}"), F.sum(F.sin(ang)).alias(f"fourier_sin_{k}")]
    hist = transactions.filter(lookback(F.col("timestamp"), snapshot, window_days))
    return hist.groupBy("customer_id").agg(*aggs)


def churn_trend(labels: DataFrame) -> DataFrame:
    """Churn rate per snapshot date."""
    return labels.groupBy("snapshot_date").agg(
        F.count(F.lit(1)).alias("customers"), F.count_if(F.col("churn_label") == 1).alias("churned"),
        F.avg(F.col("churn_label").cast("double")).alias("churn_rate"))


def fit_segments(features: DataFrame, columns: list[str], k: int = 4, seed: int = 42):
    """P5: the fitted pipeline, standardised features -> KMeans."""
    from pyspark.ml import Pipeline
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.feature import StandardScaler, VectorAssembler
    return Pipeline(stages=[
        VectorAssembler(inputCols=columns, outputCol="_raw"),
        StandardScaler(inputCol="_raw", outputCol="_scaled", withMean=True, withStd=True),
        KMeans(featuresCol="_scaled", predictionCol="segment", k=k, seed=seed)]).fit(features.na.fill(0, columns))


def kmeans_segments(features: DataFrame, columns: list[str], k: int = 4, seed: int = 42) -> DataFrame:
    """P5: the rows with a ``segment`` column."""
    model = fit_segments(features, columns, k, seed)
    return model.transform(features.na.fill(0, columns)).drop("_raw", "_scaled")


def with_nearest_check(model, features: DataFrame, columns: list[str], tolerance: float = 1e-9) -> DataFrame:
    """The segmented rows with ``nearest``: no centre is nearer than the row's own segment's."""
    from pyspark.ml.functions import vector_to_array
    rows = model.transform(features.na.fill(0, columns)).withColumn("_x", vector_to_array("_scaled"))
    centres = [c.tolist() for c in model.stages[-1].clusterCenters()]  # k rows
    away = [F.aggregate(F.zip_with("_x", F.lit(c), lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda s, d: s + d)
            for c in centres]
    rows = rows.withColumn("_away", F.array(*away))
    near = F.get("_away", F.col("segment")) <= F.array_min("_away") + tolerance
    return rows.withColumn("nearest", near).drop("_raw", "_scaled", "_x", "_away")


def segment_profiles(segmented: DataFrame, columns: list[str], label: str | None = "churn_label") -> DataFrame:
    """Size, churn rate and feature means per segment."""
    aggs = [F.count(F.lit(1)).alias("customers")]
    if label and label in segmented.columns:
        aggs.append(F.avg(F.col(label).cast("double")).alias("churn_rate"))
    aggs += [F.avg(F.col(c).cast("double")).alias(f"mean_{c}") for c in columns]
    return segmented.groupBy("segment").agg(*aggs)


def fit_segment_tree(segmented: DataFrame, columns: list[str], depth: int = 3, seed: int = 42):
    """P5: a decision tree that tells the segments apart by the unscaled features; (tree model, its columns)."""
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import DecisionTreeClassifier
    from pyspark.ml.feature import VectorAssembler
    rows = segmented.na.fill(0, columns).withColumn("_segment", F.col("segment").cast("double"))
    fitted = Pipeline(stages=[
        VectorAssembler(inputCols=columns, outputCol="_features"),
        DecisionTreeClassifier(featuresCol="_features", labelCol="_segment", maxDepth=depth, seed=seed)]).fit(rows)
    return fitted.stages[-1]


def leaf_rules(tree, columns: list[str], path: str) -> list[str]:
    """P5: the rule of each leaf as a SQL condition, read from the node table that the model saves to ``path``.

    Of several bounds on a feature the tightest stays. A tree of depth d has at most 2^d leaves. The text
    is valid in any SQL that casts text to DOUBLE; null features count as 0, as in the fit.
    """
    tree.write().overwrite().save(path)
    nodes = {r["id"]: r for r in SparkSession.getActiveSession().read.parquet(f"{path}/data").select(
        "id", "leftChild", "rightChild", "split.featureIndex", "split.leftCategoriesOrThreshold").collect()}
    rules, open_nodes = [], [(0, {})]
    while open_nodes:
        node, bounds = open_nodes.pop()
        r = nodes[node]
        if r["leftChild"] < 0:
            rules.append(_condition(bounds, columns))
            continue
        feature, cut = r["featureIndex"], r["leftCategoriesOrThreshold"][0]
        low, high = bounds.get(feature, (-math.inf, math.inf))
        open_nodes.append((r["rightChild"], bounds | {feature: (max(low, cut), high)}))
        open_nodes.append((r["leftChild"], bounds | {feature: (low, min(high, cut))}))
    return rules


def _condition(bounds: dict[int, tuple[float, float]], columns: list[str]) -> str:
    parts = []
    for feature, (low, high) in sorted(bounds.items()):
        value = f"coalesce(CAST({columns[feature]} AS DOUBLE), 0)"
        parts += [f"{value} > CAST('{low!r}' AS DOUBLE)"] if low > -math.inf else []
        parts += [f"{value} <= CAST('{high!r}' AS DOUBLE)"] if high < math.inf else []
    return " AND ".join(parts) or "TRUE"


def with_rule(rows: DataFrame, rules: list[str]) -> DataFrame:
    """The rows with ``rule_id``, the number of the rule that holds for them (from 1), in one CASE."""
    branches = " ".join(f"WHEN {r} THEN {i}" for i, r in enumerate(rules, 1))
    return rows.withColumn("rule_id", F.expr(f"CASE {branches} END"))


def rule_report(segmented: DataFrame, rules: list[str]) -> DataFrame:
    """P5: (rule_id, rule, segment, support, matching, purity, coverage) for each rule that holds for a row.

    The rule's segment is the most frequent one among its rows (ties: the smallest); purity is that
    segment's share of them, coverage their share of the segment. One aggregate over the rows; what follows
    works on rules times segments.
    """
    counts = with_rule(segmented, rules).groupBy("rule_id", "segment").agg(F.count(F.lit(1)).alias("n"))
    text = F.element_at(F.array(*map(F.lit, rules)), F.col("rule_id"))
    sized = counts.withColumn("size", F.sum("n").over(Window.partitionBy("segment")))
    best = F.max_by(F.struct("segment", "n", "size"), F.struct(F.col("n"), -F.col("segment"))).alias("b")
    return sized.groupBy("rule_id").agg(F.sum("n").alias("support"), best).select(
        "rule_id", text.alias("rule"), "b.segment", "support", F.col("b.n").alias("matching"),
        (F.col("b.n") / F.col("support")).alias("purity"), (F.col("b.n") / F.col("b.size")).alias("coverage"))


def segment_effects(segmented: DataFrame, columns: list[str]) -> DataFrame:
    """(segment, feature, customers, mean_inside, mean_outside, effect_size) of each segment against all others.

    The effect size is the difference of the means over the pooled standard deviation (null where that is 0 or a
    side has no rows). One aggregate gives count, mean and squared deviations by segment; the other segments' are
    merged from these, segments times features rows.
    """
    x = lambda c: F.col(c).cast("double")
    stats = [F.struct(F.lit(c).alias("feature"), F.count(x(c)).alias("n"), F.coalesce(F.avg(x(c)), F.lit(0.0)).alias("mean"),
                      F.coalesce(F.var_pop(x(c)), F.lit(0.0)).alias("var")) for c in columns]
    own = segmented.groupBy("segment").agg(F.count(F.lit(1)).alias("customers"), F.array(*stats).alias("s"))
    rows = own.select("segment", "customers", F.inline("s"))
    every = F.collect_list(F.struct("segment", "n", "mean", "var")).over(Window.partitionBy("feature"))
    rest = F.filter(F.sort_array(every), lambda o: ~o["segment"].eqNullSafe(F.col("segment")))
    add = lambda f: F.aggregate("rest", F.lit(0.0), lambda t, o: t + f(o))
    rows = rows.withColumn("rest", rest).withColumn("m", add(lambda o: o["n"]))
    rows = rows.withColumn("outside", F.when(F.col("m") > 0, add(lambda o: o["n"] * o["mean"]) / F.col("m")))
    spread = add(lambda o: o["n"] * (o["var"] + F.pow(o["mean"] - F.col("outside"), F.lit(2.0))))
    pooled = F.when(F.col("n") + F.col("m") > 2, F.sqrt((F.col("n") * F.col("var") + spread) / (F.col("n") + F.col("m") - 2)))
    inside = F.when(F.col("n") > 0, F.col("mean"))
    return rows.select("segment", "feature", "customers", inside.alias("mean_inside"), F.col("outside").alias("mean_outside"),
                       F.when(pooled > 0, (inside - F.col("outside")) / pooled).alias("effect_size"))
