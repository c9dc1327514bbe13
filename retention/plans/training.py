"""Path 2 — monthly training and explanation.

Loads a date range from the store (partition-pruned), trains the boosted-tree
pipeline with the leak gate, saves it, explains a hash sample with TreeSHAP on
the executors and ranks global importance.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession

from retention.operators import explain as ex
from retention.operators import model as mdl
from retention.operators import ranking
from retention.operators import split as sp
from retention.operators import treeshap
from retention.params import DEFAULT, Params
from retention.session import materialize, scratch_path
from retention.sources.store import FeatureStore


@dataclass
class TrainingResult:
    model: PipelineModel
    model_path: str
    validation_metrics: DataFrame
    gate: DataFrame
    explanations: DataFrame
    importance: DataFrame


def monthly_training(spark: SparkSession, store: FeatureStore, start: str, end: str, split_date: str,
                     run_date: str, p: Params = DEFAULT, gp: mdl.GBTParams = mdl.GBTParams(), explain_rows: int | None = None) -> TrainingResult:
    """``explain_rows``: explain a sample of so many rows instead of all of them."""
    features = store.load_features_range(start, end)
    labels = store.load_labels_range(start, end)
    model, metrics = mdl.train_model(features, labels, split_date, run_date, p, gp)
    path = store.save_model(model, run_date)
    explained = features if explain_rows is None else sp.sample_for_explanation(features, explain_rows)
    explanations = materialize(treeshap.explain(spark, model, explained, scratch_path(spark, "treeshap")))
    gate = ranking.threshold_gate(metrics, p.min_auc_threshold, p.min_precision_threshold)
    return TrainingResult(model, path, metrics, gate, explanations, ex.global_importance(explanations))
