"""Ranking metrics, split, top-N, drift and attributions."""

import itertools
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from retention.operators import drift as dr
from retention.operators import explain as ex
from retention.operators import ranking as rk
from retention.operators import split as sp
from retention.operators.scoring import top_risk


def _scored(spark, pairs):
    rows = [(f"c{i:03d}", y, float(p), int(p > 0.5)) for i, (y, p) in enumerate(pairs)]
    return spark.createDataFrame(rows, "customer_id string, churn_label int, churn_probability double, "
                                       "churn_prediction int")


def _auc_bruteforce(pairs):
    pos = [p for y, p in pairs if y == 1]
    neg = [p for y, p in pairs if y == 0]
    s = sum(1.0 if a > b else 0.5 if a == b else 0.0 for a in pos for b in neg)
    return s / (len(pos) * len(neg))


def test_auc_tied_scores_half_credit(spark):
    pairs = [(1, 0.8), (0, 0.8), (1, 0.3), (0, 0.1)]
    got = rk.auc(rk.score_curve(_scored(spark, pairs), buckets=2)).first().auc
    assert got == pytest.approx(_auc_bruteforce(pairs))


@pytest.mark.parametrize("buckets", [1, 3, 16])
def test_auc_matches_bruteforce_and_spark_ml(spark, buckets):
    rnd = random.Random(7)
    pairs = [(rnd.randint(0, 1), round(rnd.random(), 2)) for _ in range(300)]
    df = _scored(spark, pairs)
    got = rk.auc(rk.score_curve(df, buckets=buckets)).first().auc
    assert got == pytest.approx(_auc_bruteforce(pairs), abs=1e-12)
    from pyspark.ml.evaluation import BinaryClassificationEvaluator
    from pyspark.ml.functions import array_to_vector
    raw = df.select(F.col("churn_label").cast("double").alias("label"),
                    array_to_vector(F.array(1 - F.col("churn_probability"), F.col("churn_probability"))).alias("rawPrediction"))
    ref = BinaryClassificationEvaluator(labelCol="label", metricName="areaUnderROC").evaluate(raw)
    assert got == pytest.approx(ref, abs=1e-9)


def test_auc_invariant_under_monotone_rescale(spark):
    rnd = random.Random(3)
    pairs = [(rnd.randint(0, 1), rnd.random()) for _ in range(200)]
    a = rk.auc(rk.score_curve(_scored(spark, pairs))).first().auc
    b = rk.auc(rk.score_curve(_scored(spark, [(y, p ** 3 / 7) for y, p in pairs]))).first().auc
    assert a == pytest.approx(b, abs=1e-12)


def _par_bruteforce(pairs, target):
    ths = sorted({p for _, p in pairs})
    P = sum(y for y, _ in pairs)
    pts = []
    for t in ths:  # ascending threshold, as the reference's curve
        tp = sum(1 for y, p in pairs if p >= t and y == 1)
        fp = sum(1 for y, p in pairs if p >= t and y == 0)
        pts.append((tp / (tp + fp), tp / P))
    pts.append((1.0, 0.0))
    best = min(range(len(pts)), key=lambda k: (abs(pts[k][1] - target), k))
    return pts[best][0]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_precision_at_recall_matches_curve_rule(spark, seed):
    rnd = random.Random(seed)
    pairs = [(rnd.randint(0, 1), round(rnd.random(), 1)) for _ in range(80)]
    got = rk.precision_at_recall(rk.score_curve(_scored(spark, pairs), buckets=4), 0.1).first()
    assert got.precision_at_target_recall == pytest.approx(_par_bruteforce(pairs, 0.1))


def test_metrics_row_and_gate(spark):
    pairs = [(1, 0.9), (1, 0.7), (0, 0.6), (0, 0.2), (1, 0.4), (0, 0.1)]
    m = rk.metrics(_scored(spark, pairs), 0.1)
    r = m.first()
    assert r.n_rows == 6 and r.precision == pytest.approx(2 / 3) and r.recall == pytest.approx(2 / 3)
    gate = {g.metric: g.status for g in rk.threshold_gate(m, 0.99, 0.2).collect()}
    assert gate == {"auc": "warn", "precision_at_target_recall": "ok"}


def test_top_risk_tie_break(spark):
    df = spark.createDataFrame([("b", 0.9), ("a", 0.9), ("c", 0.5), ("d", 0.1)],
                               "customer_id string, churn_probability double").withColumn(
        "snapshot_date", F.lit("2024-01-15").cast("date"))
    got = [(r.customer_id, r.churn_rank) for r in top_risk(df, 3).collect()]
    assert got == [("a", 1), ("b", 2), ("c", 3)]


def test_split_is_disjoint_and_stable(spark):
    rows = [(f"id{i}", d) for i in range(400) for d in ("2024-01-01", "2024-01-15")]
    df = spark.createDataFrame(rows, "customer_id string, snapshot_date string").withColumn(
        "snapshot_date", F.col("snapshot_date").cast("date"))
    tr, va = sp.split(df, "2024-01-08")
    a = {r.customer_id for r in tr.collect()}
    b = {r.customer_id for r in va.collect()}
    assert not (a & b) and 0.6 < len(a) / 400 < 0.8
    assert a == {r.customer_id for r in sp.split(df.repartition(7), "2024-01-08")[0].collect()}
    rep = sp.split_report(tr, va).first()
    assert rep.overlap_customers == 0 and rep.status == "ok"
    uniq = df.select("customer_id").distinct()
    t, v = sp.customer_sets(uniq)
    assert sp.customer_overlap(t, v).count() == 0 and t.count() + v.count() == 400


def test_sample_fraction_is_clamped(spark):
    df = spark.createDataFrame([(f"c{i}", "2024-01-15") for i in range(50)], "customer_id string, snapshot_date string")
    assert sp.sample_for_explanation(df, 1000).count() == 50
    assert sp.sample_for_explanation(df, 25).count() == 25
    assert sp.sample_for_explanation(df, 0).count() == 0


def test_drift_constant_reference_is_zero(spark):
    cur = spark.createDataFrame([(1.0, 5.0), (3.0, 7.0)], "x double, y double")
    ref = spark.createDataFrame([(2.0, None), (2.0, None)], "x double, y double")
    got = {r.feature_name: r.drift_score for r in dr.drift(cur, ref, ["x", "y"]).collect()}
    assert got == {"x": 0.0, "y": 0.0}
    ref2 = spark.createDataFrame([(0.0, 1.0), (2.0, 3.0)], "x double, y double")
    got2 = {r.feature_name: r.drift_score for r in dr.drift(cur, ref2, ["x"]).collect()}
    assert got2["x"] == pytest.approx(1.0 / math.sqrt(2.0))


def test_linear_attributions_add_up(spark):
    df = spark.createDataFrame([("a", "2024-01-15", 1, 2.0), ("b", "2024-01-15", 3, 0.0)],
                               "customer_id string, snapshot_date string, u int, v double")
    w = [("u", 0.5), ("v", -2.0)]
    e = ex.linear_explanations(df, df, w, 0.25)
    for r in e.collect():
        src = [x for x in df.collect() if x.customer_id == r.customer_id][0]
        margin = 0.25 + 0.5 * src.u - 2.0 * src.v
        assert r.expected_value + r.shap_u + r.shap_v == pytest.approx(margin)
    imp = ex.global_importance(e).collect()
    assert [x.rank for x in imp] == [1, 2] and imp[0].feature_name == "v"


def test_prefix_strip_only_leading():
    assert ex.strip_prefix("shap_x_shap_y") == "x_shap_y"
    assert ex.strip_prefix("x_shap_y") == "x_shap_y"


def test_treeshap_matches_bruteforce_shapley():
    from retention.operators.treeshap import Tree, expected_value, margin, shap_values
    # depth-3 tree on 3 features, feature 0 used twice on one path
    left = np.array([1, 3, 5, -1, -1, 7, -1, -1, -1])
    right = np.array([2, 4, 6, -1, -1, 8, -1, -1, -1])
    feature = np.array([0, 1, 2, -1, -1, 0, -1, -1, -1])
    thr = np.array([0.5, 0.3, 0.7, 0, 0, 0.9, 0, 0, 0])
    value = np.array([0, 0, 0, 1.0, -2.0, 0, 4.0, 0.5, -1.5])
    cover = np.array([100, 40, 60, 25, 15, 35, 25, 20, 15], dtype=float)
    t = Tree(left, right, feature, thr, value, cover, 0.7)
    rnd = np.random.default_rng(0)
    X = rnd.random((25, 3))

    def cond_exp(x, S, node=0):
        if feature[node] < 0:
            return value[node]
        f = feature[node]
        if f in S:
            nxt = left[node] if x[f] <= thr[node] else right[node]
            return cond_exp(x, S, nxt)
        return (cover[left[node]] * cond_exp(x, S, left[node])
                + cover[right[node]] * cond_exp(x, S, right[node])) / cover[node]

    phi = shap_values([t], X)
    M = 3
    for r in range(X.shape[0]):
        for i in range(M):
            others = [j for j in range(M) if j != i]
            tot = 0.0
            for k in range(M):
                for S in itertools.combinations(others, k):
                    wgt = math.factorial(k) * math.factorial(M - k - 1) / math.factorial(M)
                    tot += wgt * (cond_exp(X[r], set(S) | {i}) - cond_exp(X[r], set(S)))
            assert phi[r, i] == pytest.approx(0.7 * tot, abs=1e-12)
    assert np.allclose(expected_value([t]) + phi.sum(axis=1), margin([t], X))


def test_drift_between_equals_two_frame_drift(spark):
    rows = [("a", "2024-01-01", 1.0), ("b", "2024-01-01", 3.0), ("a", "2024-01-15", 4.0), ("b", "2024-01-15", 8.0),
            ("c", "2024-01-08", 100.0)]
    df = spark.createDataFrame(rows, "customer_id string, snapshot_date string, x double").withColumn(
        "snapshot_date", F.col("snapshot_date").cast("date"))
    one = dr.drift_between(df, "2024-01-15", "2024-01-01", ["x"]).first()
    two = dr.drift(df.filter("snapshot_date = '2024-01-15'"), df.filter("snapshot_date = '2024-01-01'"), ["x"]).first()
    assert one.drift_score == pytest.approx(two.drift_score) == pytest.approx(4.0 / math.sqrt(2.0))


def test_bucket_count_scales_and_is_capped():
    assert rk.bucket_count(10) == rk.DEFAULT_BUCKETS
    assert rk.bucket_count(10**9) == 1000
    assert rk.bucket_count(10**13) == rk.MAX_BUCKETS


def test_null_scores_are_left_out(spark):
    pairs = [(1, 0.8), (0, 0.3), (1, 0.6), (0, 0.7)]
    df = _scored(spark, pairs).unionByName(spark.createDataFrame(
        [("z1", 1, None, 0)], "customer_id string, churn_label int, churn_probability double, churn_prediction int"))
    got = rk.auc(rk.score_curve(df, buckets=2)).first().auc
    assert got == pytest.approx(_auc_bruteforce(pairs))
