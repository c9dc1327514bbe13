"""Path 3 — weekly inference, evaluation and drift.

``model.transform`` keeps ids, label and score in one row, so the reference's
collect / re-create / re-join steps disappear; evaluation and drift are one
aggregate each.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame

from retention.operators import drift as dr
from retention.operators import model as mdl
from retention.operators.scoring import top_risk
from retention.params import DEFAULT, Params
from retention.sources.store import FeatureStore


@dataclass
class InferenceResult:
    predictions: DataFrame
    top: DataFrame
    metrics: DataFrame | None
    gate: DataFrame | None
    drift: DataFrame | None


def weekly_inference(store: FeatureStore, model: PipelineModel, snapshot_date: str, run_date: str,
                     reference_date: str | None = None, top_n: int = 1000, evaluate: bool = True,
                     p: Params = DEFAULT) -> InferenceResult:
    features = store.load_features(snapshot_date)
    preds = mdl.predict(model, features, run_date)
    metrics = gate = drift = None
    if evaluate:
        metrics, gate = mdl.evaluate(model, features, store.load_labels(snapshot_date), run_date, p)
    if reference_date is not None:
        cols = mdl.model_columns(model)
        drift = dr.drift(features, store.load_features(reference_date), cols)
    return InferenceResult(preds, top_risk(preds, top_n), metrics, gate, drift)
