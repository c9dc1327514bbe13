"""Path 1 — weekly processing: ingest, quality, clean, snapshot, labels, store.

The gates are observed while the cleaned tables and the snapshot are written to the
shared folder, so they scan nothing themselves; the store write reads the same
rows instead of recomputing the plan.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from retention.operators import features as feat
from retention.operators import labels as lab
from retention.operators import quality as qual
from retention.params import DEFAULT, Params
from retention.session import materialize, scratch_path
from retention.sources.store import FeatureStore


@dataclass
class WeeklyResult:
    quality: DataFrame
    null_before_fill: DataFrame
    null_after_fill: DataFrame
    churn_rate: DataFrame
    features: DataFrame
    labels: DataFrame


def weekly_processing(spark: SparkSession, raw: dict[str, DataFrame], snapshot_date: str, as_of: str,
                      store: FeatureStore | None = None, p: Params = DEFAULT) -> WeeklyResult:
    report, clean = qual.clean_with_gates(raw, as_of, p)
    c, t, i = clean["customers"], clean["transactions"], clean["interactions"]
    # I4 before the fill (where it can fire) and after it (the reference's place).
    unfilled = feat.demographic_features(feat.eligible_customers(c, snapshot_date, p), snapshot_date)
    unfilled = (unfilled.join(feat.txn_features(feat.historical(t, snapshot_date, p), snapshot_date), "customer_id", "left")
                .join(feat.interaction_features(feat.historical(i, snapshot_date, p), snapshot_date), "customer_id", "left"))
    before = qual.null_report(unfilled, p)
    snapshot = feat.weekly_snapshot(c, t, i, snapshot_date, p)
    features, after = qual.write_with_null_report(snapshot, scratch_path(spark, "snapshot"), p)
    qual.enforce_null_report(after)
    labels = materialize(lab.churn_labels(c, t, i, snapshot_date, p))
    rate = lab.churn_rate(labels, p)
    if store is not None:
        store.store_features(features)
        store.store_labels(labels)
    return WeeklyResult(report, before, after, rate, features, labels)
