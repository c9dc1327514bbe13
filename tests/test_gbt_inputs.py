"""The boosted-tree queries: inputs made once, and execution settings that leave the trees alone."""

import dataclasses
import random

from pyspark.sql import functions as F

from retention.operators import model as mdl
from retention.plans import catalog

SMALL = mdl.GBTParams(max_iter=3, max_depth=3)


def _rows(spark, n=600):
    r = random.Random(3)
    rows = []
    for i in range(n):
        a, b = r.gauss(0, 1), r.randint(0, 5)
        rows.append((f"c{i}", "2024-01-01" if i % 3 else "2024-01-15", a, b, int(a + b + r.gauss(0, 1) > 2)))
    return spark.createDataFrame(rows, "customer_id string, snapshot_date string, a double, b int, churn_label int").withColumn("snapshot_date", F.to_date("snapshot_date")).repartition(3, "customer_id")


def test_cached_node_ids_do_not_change_the_trees(spark):
    frame, small = _rows(spark), mdl.GBTParams(max_iter=5)
    assert not small.cache_node_ids
    one, two = (mdl.fit(frame, ["a", "b"], dataclasses.replace(small, cache_node_ids=c)).stages[-1] for c in (False, True))
    assert one.toDebugString.split("\n", 1)[1] == two.toDebugString.split("\n", 1)[1]


def test_features_are_made_once_for_the_fit_and_the_validation(spark, monkeypatch):
    made = []
    frame = _rows(spark)

    def features(spark, sf, *a):
        made.append("features")
        return frame.drop("churn_label")

    monkeypatch.setattr(catalog, "multi_features_df", features)
    monkeypatch.setattr(catalog, "multi_labels_df", lambda *a: frame.select("customer_id", "snapshot_date", "churn_label"))
    monkeypatch.setattr(mdl, "GBTParams", lambda: SMALL)
    monkeypatch.setattr(catalog, "_MODELS", {})
    got = catalog.q_gbt_val_scores(spark, "none").collect()
    assert made == ["features"] and got and all(r.in_range and r.class_agrees and r.reload_equal for r in got)
    del made[:]
    every = catalog.q_gbt_shap_additive(spark, "none").collect()
    assert made == ["features"] and len(every) == 600 and all(r.additive for r in every)
