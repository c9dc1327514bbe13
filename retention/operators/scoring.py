"""Scoring and top-N (M4 form, B29, F1).

``linear_score`` is a fixed, closed-form scorer (a linear margin squashed to
(0, 1) with ``0.5 + 0.5 * z / (1 + |z|)``): only +, *, / and abs, so Spark and
DuckDB give bit-equal probabilities and every metric downstream can be
checked against SQL. Spark ML models (``model.py``) produce the same columns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from retention.functions.timewin import date_lit

# Weights of this library's own linear scorer (feature, weight), in order.
LINEAR_INTERCEPT = 0.5
LINEAR_WEIGHTS = [
    ("txn_count_30d", -0.3),
    ("login_count_30d", -0.2),
    ("days_since_last_txn", 0.01),
    ("active_products_count", -0.1),
    ("support_interactions_30d", 0.2),
]
THRESHOLD = 0.5


def margin(weights=LINEAR_WEIGHTS, intercept: float = LINEAR_INTERCEPT) -> Column:
    z = F.lit(float(intercept))
    for name, w in weights:
        z = z + F.lit(float(w)) * F.col(name).cast("double")
    return z


def squash(z: Column) -> Column:
    return F.lit(0.5) + F.lit(0.5) * z / (F.lit(1.0) + F.abs(z))


def linear_score(features: DataFrame, run_date: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """Predictions frame: ids, probability, 0/1 class (p > 0.5), prediction date."""
    p = squash(margin())
    return features.select(
        "customer_id", "snapshot_date", *keep,
        p.alias("churn_probability"),
        (p > THRESHOLD).cast("int").alias("churn_prediction"),
        date_lit(run_date).alias("prediction_date"))


def top_risk(predictions: DataFrame, top_n: int = 1000) -> DataFrame:
    """the ``top_n`` highest probabilities with a 1-based rank.

    ``orderBy(...).limit(n)`` plans as a distributed top-k (each task keeps n
    rows); the rank window then runs over those n rows only, never the table.
    Ties are broken by ``customer_id`` then ``snapshot_date``.
    """
    order = [F.col("churn_probability").desc(), F.col("customer_id").asc(), F.col("snapshot_date").asc()]
    from pyspark.sql import Window
    top = predictions.orderBy(*order).limit(int(top_n))
    return top.withColumn("churn_rank", F.row_number().over(Window.orderBy(*order)))
