"""Feature drift (D10, M12): ``|mean_cur - mean_ref| / std_ref``, 0 when std_ref is 0 or null.

One aggregate per frame over all features (not two jobs per feature), unpivoted
to one row per feature; the two small per-feature tables are joined on name.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def feature_stats(df: DataFrame, columns: list[str]) -> DataFrame:
    """Mean and sample std of every column, long format (feature_name, mean, std)."""
    aggs = []
    for c in columns:
        x = F.col(c).cast("double")
        aggs += [F.avg(x).alias(f"m__{c}"), F.stddev_samp(x).alias(f"s__{c}")]
    a = df.agg(*aggs)
    return a.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("feature_name"), F.col(f"m__{c}").alias("mean"), F.col(f"s__{c}").alias("std"))
        for c in columns])))


def drift(current: DataFrame, reference: DataFrame, columns: list[str]) -> DataFrame:
    cur = feature_stats(current, columns).select(
        "feature_name", F.col("mean").alias("current_mean"), F.col("std").alias("current_std"))
    ref = feature_stats(reference, columns).select(
        "feature_name", F.col("mean").alias("reference_mean"), F.col("std").alias("reference_std"))
    j = cur.join(ref, "feature_name")
    score = F.when(F.col("reference_std") > 0,
                   F.abs(F.col("current_mean") - F.col("reference_mean")) / F.col("reference_std")
                   ).otherwise(F.lit(0.0))
    return j.withColumn("drift_score", score)


def drift_between(features: DataFrame, current_date: str, reference_date: str, columns: list[str]) -> DataFrame:
    """M12 over one frame holding both snapshot dates: one ``groupBy(snapshot_date)``
    aggregate (two output rows), unpivoted and folded per feature, no join."""
    from retention.functions.timewin import date_lit
    s = F.col("snapshot_date")
    side = F.when(s == date_lit(current_date), "cur").when(s == date_lit(reference_date), "ref")
    tagged = features.filter(side.isNotNull()).withColumn("_side", side)
    aggs = []
    for c in columns:
        x = F.col(c).cast("double")
        aggs += [F.avg(x).alias(f"m__{c}"), F.stddev_samp(x).alias(f"s__{c}")]
    per_side = tagged.groupBy("_side").agg(*aggs)
    long = per_side.select("_side", F.inline(F.array(*[
        F.struct(F.lit(c).alias("feature_name"), F.col(f"m__{c}").alias("mean"), F.col(f"s__{c}").alias("std"))
        for c in columns])))

    def pick(which: str, col: str):
        return F.max(F.when(F.col("_side") == which, F.col(col)))
    folded = long.groupBy("feature_name").agg(
        pick("cur", "mean").alias("current_mean"), pick("cur", "std").alias("current_std"),
        pick("ref", "mean").alias("reference_mean"), pick("ref", "std").alias("reference_std"))
    score = F.when(F.col("reference_std") > 0,
                   F.abs(F.col("current_mean") - F.col("reference_mean")) / F.col("reference_std")
                   ).otherwise(F.lit(0.0))
    return folded.withColumn("drift_score", score)
