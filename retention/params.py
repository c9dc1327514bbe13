"""Business parameters and their defaults."""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class Params:
    # Fixed values that must equal the reference's defaults.
    churn_horizon_days: int = 30
    feature_window_days: int = 90
    minimum_tenure_days: int = 60
    temporal_split_date: str = "2024-09-01"
    train_ratio: float = 0.7
    min_auc_threshold: float = 0.75
    min_precision_threshold: float = 0.2
    target_recall: float = 0.1
    shap_sample_size: int = 1000
    max_staleness_days: int = 7
    null_error_ratio: float = 0.5
    null_warn_ratio: float = 0.1
    churn_rate_low: float = 0.02
    churn_rate_high: float = 0.15
    seed: int = 42
    # Sub-windows of the feature lookback.
    sub_windows: tuple[int, ...] = field(default=(30, 60, 90))


DEFAULT = Params()

# Session settings the reference runs with (adaptive execution is on by default
# in Spark 4; the broadcast threshold is raised to 35 MB).
SESSION_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.autoBroadcastJoinThreshold": "36700160",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # midnight bounds must not move with the cluster's zone
    "spark.sql.session.timeZone": "UTC",
}
