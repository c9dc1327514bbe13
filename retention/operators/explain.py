"""Per-row attributions and global importance.

For a linear margin ``z = b + sum w_i x_i`` the exact Shapley values against a
background mean are ``w_i * (x_i - mean_i)`` and the expected value is
``b + sum w_i mean_i``: plain column arithmetic, computed where the rows are.
The background means are one aggregate row (one value per feature).
Tree models use ``treeshap.py``; both produce the same table shape:
``customer_id, snapshot_date, expected_value, shap_<feature>...``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from retention.explain_names import PREFIX


def background_stats(background: DataFrame, columns: list[str]) -> tuple[int, dict[str, float]]:
    """Row count and column means in one aggregate job (one small row to the driver)."""
    r = background.agg(F.count(F.lit(1)).alias("_n"),
                       *[F.avg(F.col(c).cast("double")).alias(c) for c in columns]).first()
    return int(r["_n"]), {c: float(r[c] or 0.0) for c in columns}


def linear_explanations(sample: DataFrame, background: DataFrame | None, weights: list[tuple[str, float]],
                        intercept: float, means: dict[str, float] | None = None) -> DataFrame:
    """M13 + M14 for a linear margin (``means`` may come from ``background_stats``)."""
    if means is None:
        means = background_stats(background, [n for n, _ in weights])[1]
    ev = float(intercept) + sum(float(w) * float(means[n] or 0.0) for n, w in weights)
    cols = [(F.lit(float(w)) * (F.col(n).cast("double") - F.lit(float(means[n] or 0.0)))).alias(PREFIX + n)
            for n, w in weights]
    return sample.select("customer_id", "snapshot_date", F.lit(ev).alias("expected_value"), *cols)


def strip_prefix(name: str) -> str:
    """Remove the leading ``shap_`` only (a name may contain it elsewhere)."""
    return name[len(PREFIX):] if name.startswith(PREFIX) else name


def global_importance(explanations: DataFrame) -> DataFrame:
    """D12 + F2: mean |attribution| per feature in one aggregate, ranked 1..k.

    The rank window runs over one row per feature (bounded by the feature count).
    """
    cols = [c for c in explanations.columns if c.startswith(PREFIX)]
    a = explanations.agg(*[F.avg(F.abs(F.col(c))).alias(c) for c in cols])
    long = a.select(F.inline(F.array(*[
        F.struct(F.lit(strip_prefix(c)).alias("feature_name"), F.col(c).alias("importance")) for c in cols])))
    w = Window.orderBy(F.col("importance").desc(), F.col("feature_name").asc())
    return long.withColumn("rank", F.row_number().over(w))
