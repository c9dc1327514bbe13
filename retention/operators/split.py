"""Training set and leak-free splits.

The customer-level split is a hash predicate on ``customer_id`` (row-local,
stable under any partitioning, no join and no shuffle), instead of a seeded
``sample`` followed by ``subtract``: seeded sampling picks different rows when
the partitioning changes, so it cannot promise the same split on every run.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retention.functions.hashing import key_hash, split_predicate
from retention.functions.timewin import date_lit
from retention.params import DEFAULT, Params

KEYS = ["customer_id", "snapshot_date"]


def training_set(features: DataFrame, labels: DataFrame) -> DataFrame:
    """Features joined to labels on both keys (inner)."""
    return features.join(labels, KEYS, "inner")


def customer_sets(unique_customers: DataFrame, p: Params = DEFAULT) -> tuple[DataFrame, DataFrame]:
    """G1 over a distinct-customer frame; the validation side is the EXCEPT."""
    train = unique_customers.filter(split_predicate(F.col("customer_id"), p.train_ratio))
    return train, unique_customers.subtract(train)


def customer_overlap(train_customers: DataFrame, val_customers: DataFrame) -> DataFrame:
    """Customers in both sets (must be empty)."""
    return train_customers.intersect(val_customers)


def split(training: DataFrame, split_date: str, p: Params = DEFAULT) -> tuple[DataFrame, DataFrame]:
    """G2 + B22 + C4: train (train customer, date <= split) and val (val customer, date > split). Each is a
    plain conjunction, so the date test reaches the partitions of a stored table."""
    is_train = split_predicate(F.col("customer_id"), p.train_ratio)
    early = F.col("snapshot_date") <= date_lit(split_date)
    return training.filter(early & is_train), training.filter(~early & ~is_train)


def split_report(train_df: DataFrame, val_df: DataFrame) -> DataFrame:
    """I6 over the two frames themselves: customer counts per side, customers in both, sample counts,
    date order, status. Grouped first by customer (combined map-side), then over customers."""
    sides = train_df.select("customer_id", "snapshot_date", F.lit(True).alias("_train")).unionByName(
        val_df.select("customer_id", "snapshot_date", F.lit(False).alias("_train")))
    t = F.col("_train")
    per_cust = sides.groupBy("customer_id").agg(
        F.count_if(t).alias("train_rows"), F.count_if(~t).alias("val_rows"),
        F.max(F.when(t, F.col("snapshot_date"))).alias("max_train"),
        F.min(F.when(~t, F.col("snapshot_date"))).alias("min_val"))
    a = per_cust.agg(
        F.count_if(F.col("train_rows") > 0).alias("train_customers"),
        F.count_if(F.col("val_rows") > 0).alias("val_customers"),
        F.count_if((F.col("train_rows") > 0) & (F.col("val_rows") > 0)).alias("overlap_customers"),
        F.coalesce(F.sum("train_rows"), F.lit(0)).alias("train_samples"),
        F.coalesce(F.sum("val_rows"), F.lit(0)).alias("val_samples"),
        F.max("max_train").alias("max_train_date"),
        F.min("min_val").alias("min_val_date"))
    bad = (F.col("overlap_customers") > 0) | (F.col("max_train_date") > F.col("min_val_date"))
    return a.withColumn("status", F.when(bad, "error").otherwise("ok"))


def enforce_split(report: DataFrame) -> None:
    r = report.first()
    if r is not None and r.status == "error":
        raise ValueError(f"Split leakage: overlap={r.overlap_customers}, "
                         f"max_train_date={r.max_train_date}, min_val_date={r.min_val_date}")


def sample_for_explanation(features: DataFrame, n: int) -> DataFrame:
    """The ``n`` rows (all, if there are fewer) whose (customer_id, snapshot_date) have the smallest
    hashes; a distributed top-n, no count needed. A caller asks for it; nothing samples by default."""
    key = F.concat_ws("|", F.col("customer_id"), F.col("snapshot_date").cast("string"))
    return features.orderBy(key_hash(key), "customer_id", "snapshot_date").limit(n)
