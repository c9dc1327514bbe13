"""Data profile of the raw tables.

The reference computes these with pandas on one machine (and D23 with a
per-customer loop over all rows). Here each item is one grouped or global
aggregate; per-customer work is a ``groupBy(customer_id)`` with partial
aggregation, and "sets of ids" become last-activity times per customer.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from retention.functions.timewin import midnight_lit, shift
from retention.operators.quality import elapsed_days

# Inactivity cutoffs (days), recency thresholds (days) and the products
# whose penetration is reported, in the reference's order.
INACTIVITY_CUTOFFS = [7, 14, 30, 60, 90]
RECENCY_THRESHOLDS = [30, 60, 90]
PENETRATION_PRODUCTS = ["checking", "savings", "credit_card", "loan"]


def value_share(df: DataFrame, column: str, table: str) -> DataFrame:
    """Count and share of each value. The total is a scalar subquery over the
    grouped rows (same shuffle, reused): no join and no single-partition window,
    whatever the number of distinct values."""
    g = df.groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("rows"))
    total = g.select(F.sum("rows")).scalar()
    return g.select(F.lit(table).alias("table_name"), "value", "rows", (F.col("rows") / total).alias("share"))


def monthly_volume(df: DataFrame, table: str, ts: str = "timestamp") -> DataFrame:
    """Rows per calendar month, then mean and sample std over the months present."""
    m = df.groupBy(F.date_trunc("month", F.col(ts)).alias("month")).agg(F.count(F.lit(1)).alias("rows"))
    return m.agg(F.lit(table).alias("table_name"), F.count(F.lit(1)).alias("months"),
                 F.avg("rows").alias("monthly_mean"), F.stddev_samp("rows").alias("monthly_std"))


def last_times(df: DataFrame, name: str, ts: str = "timestamp") -> DataFrame:
    return df.groupBy("customer_id").agg(F.max(ts).alias(name))


def last_activity(customers: DataFrame, transactions: DataFrame, interactions: DataFrame) -> DataFrame:
    """Later of last transaction and last interaction per customer (nulls skipped).

    Two per-customer aggregates and two left joins on the same key, instead of
    the reference's scan of both tables for every customer.
    """
    c = customers.select("customer_id")
    j = (c.join(last_times(transactions, "last_txn"), "customer_id", "left")
          .join(last_times(interactions, "last_interaction"), "customer_id", "left"))
    return j.withColumn("last_activity", F.greatest("last_txn", "last_interaction"))


def _activity_ids(transactions: DataFrame, interactions: DataFrame) -> DataFrame:
    """Last activity per id over both fact tables (ids need not be in ``customers``)."""
    both = (transactions.select("customer_id", "timestamp")
            .unionByName(interactions.select("customer_id", "timestamp")))
    return both.groupBy("customer_id").agg(F.max("timestamp").alias("last_activity"))


def inactive_by_cutoff(customers: DataFrame, transactions: DataFrame, interactions: DataFrame,
                       end: str, cutoffs: list[int] = INACTIVITY_CUTOFFS) -> DataFrame:
    """D16 (+E9): for each cutoff, ids active strictly after ``end - cutoff`` and the
    customers left inactive (``#customers - #active``), as the reference counts them.

    Customer rows and per-id last activity are stacked and counted in one aggregate.
    """
    act = _activity_ids(transactions, interactions).select(
        F.lit(0).alias("_cust"), F.col("last_activity"))
    cust = customers.select(F.lit(1).alias("_cust"), F.lit(None).cast("timestamp_ntz").alias("last_activity"))
    u = act.unionByName(cust)
    counts = u.agg(F.sum("_cust").alias("n"),
                   *[F.count_if(F.col("last_activity") > midnight_lit(shift(end, -c))).alias(f"a{c}")
                     for c in cutoffs])
    out = counts.select("n", F.inline(F.array(*[
        F.struct(F.lit(c).alias("cutoff_days"), F.col(f"a{c}").alias("active_ids")) for c in cutoffs])))
    n = F.coalesce(F.col("n"), F.lit(0))
    inactive = n - F.col("active_ids")
    return out.select("cutoff_days", "active_ids", n.alias("customers"), inactive.alias("inactive_customers"),
                      F.when(n > 0, inactive / n * 100).otherwise(F.lit(0.0)).alias("inactive_pct"))


def calendar_months(year: int) -> list[tuple[str, str]]:
    return [(f"{year}-{m:02d}-01", f"{year + (m == 12)}-{(m % 12) + 1:02d}-01") for m in range(1, 13)]


def activity_trend(transactions: DataFrame, interactions: DataFrame, year: int) -> DataFrame:
    """Least-squares slope of (transactions + interactions) per calendar month of
    ``year`` against month number 1..12; empty months count as 0."""
    both = (transactions.select("timestamp").unionByName(interactions.select("timestamp"))
            .filter((F.col("timestamp") >= midnight_lit(f"{year}-01-01"))
                    & (F.col("timestamp") < midnight_lit(f"{year + 1}-01-01"))))
    per = both.groupBy(F.month("timestamp").alias("month")).agg(F.count(F.lit(1)).alias("rows"))
    months = both.sparkSession.range(1, 13).select(F.col("id").cast("int").alias("month"))
    full = months.join(per, "month", "left").na.fill(0, ["rows"])
    return full.agg(F.lit(year).alias("year"), F.sum("rows").alias("activity_rows"),
                    F.regr_slope(F.col("rows").cast("double"), F.col("month").cast("double")).alias("trend"))


def lifecycle_distribution(customers: DataFrame, transactions: DataFrame, interactions: DataFrame,
                           end: str) -> DataFrame:
    """Stable (active after end-30d), at-risk (after end-60d but not end-30d),
    churned (customers not active after end-60d, including never active).

    Shares are of the customer count, taken by a window over the few grouped rows.
    """
    act = _activity_ids(transactions, interactions)
    ids = customers.select("customer_id", F.lit(True).alias("_is_customer")).distinct()
    j = act.join(ids, "customer_id", "full")
    t30, t60 = midnight_lit(shift(end, -30)), midnight_lit(shift(end, -60))
    la = F.col("last_activity")
    state = (F.when(la > t30, "stable").when(la > t60, "at_risk")
             .when(F.col("_is_customer"), "churned"))
    g = j.groupBy(state.alias("state")).agg(
        F.count(F.lit(1)).alias("customers"), F.count_if(F.col("_is_customer")).alias("_in_customers"))
    n = F.sum("_in_customers").over(Window.partitionBy(F.lit(1)))
    out = g.select("state", "customers", n.alias("n")).filter(F.col("state").isNotNull())
    return out.select("state", "customers",
                      F.when(F.col("n") > 0, F.col("customers") / F.col("n") * 100).otherwise(F.lit(0.0)).alias("pct"))


def txn_stats(transactions: DataFrame) -> DataFrame:
    """Per customer count, sum, mean, sample std of amount; first and last time."""
    a = F.col("amount")
    return transactions.groupBy("customer_id").agg(
        F.count(a).alias("txn_count"), F.sum(a).alias("txn_sum"), F.avg(a).alias("txn_mean"),
        F.stddev_samp(a).alias("txn_std"), F.min("timestamp").alias("first_txn"),
        F.max("timestamp").alias("last_txn"))


def interaction_stats(interactions: DataFrame) -> DataFrame:
    """Per customer count, first and last time."""
    return interactions.groupBy("customer_id").agg(
        F.count("interaction_type").alias("interaction_count"),
        F.min("timestamp").alias("first_interaction"), F.max("timestamp").alias("last_interaction"))


def age_summary(customers: DataFrame) -> DataFrame:
    """describe() of age: count, mean, std, min, max."""
    a = F.col("age")
    return customers.agg(F.count(a).alias("age_count"), F.avg(a).alias("age_mean"),
                         F.stddev_samp(a).alias("age_std"), F.min(a).alias("age_min"), F.max(a).alias("age_max"))


def penetration(customers: DataFrame) -> DataFrame:
    """Share of customers holding each product (booleans averaged as 0/1)."""
    return customers.agg(*[F.avg(F.col(f"has_{p}").cast("int")).alias(p)
                           for p in PENETRATION_PRODUCTS])


def recency_distribution(last: DataFrame, end: str, thresholds: list[int] = RECENCY_THRESHOLDS) -> DataFrame:
    """Over customers with any activity, mean floored days since last activity and
    the count and share at or above each threshold."""
    d = last.filter(F.col("last_activity").isNotNull()).select(
        elapsed_days(end, F.col("last_activity")).alias("days"))
    aggs = [F.count(F.lit(1)).alias("active_customers"), F.avg("days").alias("mean_days")]
    for t in thresholds:
        aggs.append(F.count_if(F.col("days") >= t).alias(f"inactive_{t}d"))
    a = d.agg(*aggs)
    shares = [F.when(F.col("active_customers") > 0, F.col(f"inactive_{t}d") / F.col("active_customers") * 100)
              .otherwise(F.lit(0.0)).alias(f"inactive_{t}d_pct") for t in thresholds]
    return a.select("*", *shares)


def profile_counts(customers: DataFrame, transactions: DataFrame, interactions: DataFrame) -> DataFrame:
    """D25 + D26: table sizes, rows per customer and date range of each fact table.

    Three independent global aggregates stacked into one row (no join).
    """
    def one(df: DataFrame, name: str, time_range: bool) -> DataFrame:
        aggs = [F.count(F.lit(1)).alias("v_rows")]
        aggs += ([F.min("timestamp").alias("v_min"), F.max("timestamp").alias("v_max")] if time_range
                 else [F.lit(None).cast("timestamp_ntz").alias("v_min"),
                       F.lit(None).cast("timestamp_ntz").alias("v_max")])
        return df.agg(*aggs).withColumn("table_name", F.lit(name))
    parts = (one(customers, "customers", False).unionByName(one(transactions, "transactions", True))
             .unionByName(one(interactions, "interactions", True)))

    def pick(name: str, col: str) -> Column:
        return F.max(F.when(F.col("table_name") == name, F.col(col)))
    w = parts.agg(pick("customers", "v_rows").alias("customers"), pick("transactions", "v_rows").alias("transactions"),
                  pick("interactions", "v_rows").alias("interactions"),
                  pick("transactions", "v_min").alias("txn_first"), pick("transactions", "v_max").alias("txn_last"),
                  pick("interactions", "v_min").alias("interaction_first"),
                  pick("interactions", "v_max").alias("interaction_last"))
    per = lambda c: F.when(F.col("customers") > 0, F.col(c) / F.col("customers")).otherwise(F.lit(0.0))
    return w.select("*", per("transactions").alias("txn_per_customer"),
                    per("interactions").alias("interactions_per_customer"))


def profile_report(customers: DataFrame, transactions: DataFrame, interactions: DataFrame, end: str,
                   year: int) -> dict[str, DataFrame]:
    """Every profile item as its own small frame (each one aggregate job when run)."""
    last = last_activity(customers, transactions, interactions)
    return {
        "counts": profile_counts(customers, transactions, interactions),
        "product_share": value_share(transactions, "product", "transactions"),
        "interaction_share": value_share(interactions, "interaction_type", "interactions"),
        "monthly_volume": monthly_volume(transactions, "transactions"),
        "inactive_by_cutoff": inactive_by_cutoff(customers, transactions, interactions, end),
        "activity_trend": activity_trend(transactions, interactions, year),
        "lifecycle": lifecycle_distribution(customers, transactions, interactions, end),
        "age": age_summary(customers),
        "penetration": penetration(customers),
        "recency": recency_distribution(last, end),
    }
