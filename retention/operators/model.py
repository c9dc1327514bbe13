"""Spark ML model operators.

The reference collects the training matrix to the driver for xgboost; here the
matrix never leaves the executors: a ``Pipeline`` of ``VectorAssembler`` and
``GBTClassifier`` fits on the split DataFrame and ``transform`` scores rows in
place, keeping ids, label and score in the same row.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, NumericType

from retention.functions.timewin import date_lit
from retention.operators import ranking, split as splitting
from retention.params import DEFAULT, Params

EXCLUDE = ("customer_id", "snapshot_date", "churn_label", "churned_date")


@dataclass(frozen=True)
class GBTParams:
    # The reference's boosting settings.
    max_depth: int = 6
    max_iter: int = 100
    step_size: float = 0.1
    subsampling_rate: float = 0.8
    feature_subset: str = "0.8"
    seed: int = 42
    # Execution settings (not model semantics): at depth 6 a row finds its node from
    # its bins in less time than a cached id is read and written at every level, and
    # the trees are the same; checkpoint the boosting state every 10 rounds into the
    # shared checkpoint folder so lineage stays short over 100 rounds.
    cache_node_ids: bool = False
    checkpoint_interval: int = 10


def feature_columns(df: DataFrame, exclude: tuple[str, ...] = EXCLUDE) -> list[str]:
    """Model inputs by key exclusion, numeric and boolean columns only (strings and
    dates never reach the model, unlike the reference)."""
    return [f.name for f in df.schema.fields if f.name not in exclude
            and isinstance(f.dataType, (NumericType, BooleanType))]


def prepare(df: DataFrame, columns: list[str]) -> DataFrame:
    """M3/M5 + B21: cast inputs to double and fill nulls with 0."""
    casted = df.select(*[c for c in df.columns if c not in columns],
                       *[F.col(c).cast("double").alias(c) for c in columns])
    return casted.na.fill(0.0, columns)


def pipeline(columns: list[str], gp: GBTParams = GBTParams()) -> Pipeline:
    """M1: assembler + boosted trees with the reference's settings."""
    gbt = GBTClassifier(labelCol="churn_label", featuresCol="features", maxDepth=gp.max_depth,
                        maxIter=gp.max_iter, stepSize=gp.step_size, subsamplingRate=gp.subsampling_rate,
                        featureSubsetStrategy=gp.feature_subset, seed=gp.seed,
                        cacheNodeIds=gp.cache_node_ids, checkpointInterval=gp.checkpoint_interval)
    return Pipeline(stages=[VectorAssembler(inputCols=columns, outputCol="features"), gbt])


def fit(train_df: DataFrame, columns: list[str], gp: GBTParams = GBTParams()) -> PipelineModel:
    from retention.session import checkpoint_root
    checkpoint_root(train_df.sparkSession)  # GBT checkpoints only when a folder is registered
    return pipeline(columns, gp).fit(prepare(train_df, columns))


def model_columns(model: PipelineModel) -> list[str]:
    return list(model.stages[0].getInputCols())


def predict(model: PipelineModel, features: DataFrame, run_date: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """M4: probability of class 1 and the 0/1 class, ids kept in the row (B29 as a parameter)."""
    cols = model_columns(model)
    scored = model.transform(prepare(features, cols))
    return scored.select(
        "customer_id", "snapshot_date", *keep,
        vector_to_array("probability")[1].alias("churn_probability"),
        F.col("prediction").cast("int").alias("churn_prediction"),
        date_lit(run_date).alias("prediction_date"))


def train_model(features: DataFrame, labels: DataFrame, split_date: str, run_date: str,
                p: Params = DEFAULT, gp: GBTParams = GBTParams(), store=None,
                check_leaks: bool = True, training: DataFrame | None = None) -> tuple[PipelineModel, DataFrame]:
    """M2: join, split, leak gate, fit, validate (M11), optionally save.

    The joined training table feeds the leak report, the fit and the validation
    scoring, so it is checkpointed once to the shared folder rather than
    recomputed from its inputs three times; a caller that goes on with it gives it
    as ``training``. Returns the fitted pipeline and the one-row validation metrics.
    """
    from retention.session import materialize
    if training is None:
        training = materialize(splitting.training_set(features, labels))
    train_df, val_df = splitting.split(training, split_date, p)
    if check_leaks:
        splitting.enforce_split(splitting.split_report(train_df, val_df))
    cols = feature_columns(training)
    model = fit(train_df, cols, gp)
    val_scored = predict(model, val_df, run_date, keep=("churn_label",))
    metrics = ranking.metrics(val_scored, p.target_recall)
    if store is not None:
        store.save_model(model, run_date)
    return model, metrics


def evaluate(model: PipelineModel, features: DataFrame, labels: DataFrame, run_date: str,
             p: Params = DEFAULT) -> tuple[DataFrame, DataFrame]:
    """Join on both keys, score once with the label carried along (no second join,
    no label leakage into the inputs), metrics and the threshold gate (I7)."""
    joined = splitting.training_set(features, labels)
    scored = predict(model, joined, run_date, keep=("churn_label",))
    m = ranking.metrics(scored, p.target_recall)
    return m, ranking.threshold_gate(m, p.min_auc_threshold, p.min_precision_threshold)
