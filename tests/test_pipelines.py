"""The three paths end to end on sf0.001 (small GBT so the test stays quick)."""

from pyspark.sql import functions as F

from retention.operators.model import GBTParams
from retention.plans.inference import weekly_inference
from retention.plans.training import monthly_training
from retention.plans.weekly import weekly_processing
from retention.session import scratch_path
from retention.sources import fixtures as fx
from retention.sources.raw import ingest, write_dated
from retention.sources.store import FeatureStore
from tests.conftest import SF_SMALL


def test_weekly_training_inference(spark):
    raw_root = scratch_path(spark, "t-raw")
    write_dated(fx.tables(spark, SF_SMALL).as_dict(), raw_root, "2024-01-15")
    raw = ingest(spark, raw_root, "2024-01-15")
    store = FeatureStore(spark, scratch_path(spark, "t-store"))
    for s in ("2024-01-01", "2024-01-08", "2024-01-15"):
        res = weekly_processing(spark, raw, s, "2024-02-15", store)
        assert res.features.count() > 0
        assert {r.status for r in res.quality.collect()} <= {"ok", "warn"}
    assert store.load_features_range("2024-01-01", "2024-01-31").select("snapshot_date").distinct().count() == 3
    tr = monthly_training(spark, store, "2024-01-01", "2024-01-31", "2024-01-08", "2024-02-15",
                          gp=GBTParams(max_iter=3, max_depth=3))
    assert tr.explanations.count() > 0 and tr.importance.count() == len(tr.model.stages[0].getInputCols())
    inf = weekly_inference(store, tr.model, "2024-01-15", "2024-02-15", reference_date="2024-01-01", top_n=10)
    assert inf.top.count() == 10
    m = inf.metrics.first()
    assert 0.0 <= m.auc <= 1.0
    assert inf.drift.filter(F.col("drift_score") < 0).count() == 0


def test_treeshap_local_accuracy_on_spark_gbt(spark):
    from pyspark.ml.functions import vector_to_array

    from retention.operators import model as M
    from retention.operators import treeshap as TS
    from retention.plans import catalog as C
    training = C.training_df(spark, SF_SMALL)
    cols = M.feature_columns(training)
    model = M.fit(training, cols, GBTParams(max_iter=4, max_depth=4))
    ex = TS.explain(spark, model, training, scratch_path(spark, "t-shap"))
    raw = model.transform(M.prepare(training, cols)).select(
        "customer_id", "snapshot_date", vector_to_array("rawPrediction")[1].alias("margin"))
    shap_cols = [c for c in ex.columns if c.startswith("shap_")]
    assert len(shap_cols) == len(cols)
    total = F.col("expected_value")
    for c in shap_cols:
        total = total + F.col(c)
    err = ex.join(raw, ["customer_id", "snapshot_date"]).agg(F.max(F.abs(total - F.col("margin"))).alias("e"),
                                                              F.count(F.lit(1)).alias("n")).first()
    assert err.n == training.count() and err.e < 1e-9


def test_keys_are_unique_in_labels_and_features(spark):
    from retention.plans import catalog as C
    for df in (C.multi_labels_df(spark, SF_SMALL), C.multi_features_df(spark, SF_SMALL), C.training_df(spark, SF_SMALL)):
        dup = df.groupBy("customer_id", "snapshot_date").count().filter(F.col("count") > 1).count()
        assert dup == 0
    lab = C.multi_labels_df(spark, SF_SMALL)
    # churned rows carry their snapshot date, active rows none
    bad = lab.filter(((F.col("churn_label") == 1) & (F.col("churned_date") != F.col("snapshot_date")))
                     | ((F.col("churn_label") == 0) & F.col("churned_date").isNotNull())).count()
    assert bad == 0
