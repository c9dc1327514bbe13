"""Many snapshots in one plan (D4 over a date list, L2 backfill).

The reference builds one snapshot per call and loops on the driver, scanning
the fact tables once per date. Here both fact tables are read once and combined
to a state a customer and day (``daystate``); only these rows meet the snapshots
whose windows hold their day, by a bucketed range join against the small
snapshot list, and one ``groupBy(customer_id, snapshot_date)`` merges them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from retention.functions.timewin import shift, to_day, ts_between_midnights
from retention.operators import features as feat
from retention.operators.daystate import DAY, active_days, day_states, measure_over
from retention.operators.labels import labels_from_flags
from retention.operators.rangejoin import day_number, range_join
from retention.params import DEFAULT, Params

# Upper bound on distinct snapshot dates we broadcast; dates are a calendar
# domain, so even decades of daily snapshots stay far below it.
MAX_SNAPSHOT_DATES = 100_000


def snapshot_frame(spark: SparkSession, dates: list[str]) -> DataFrame:
    """The snapshot list as a small frame; its size is checked here, which is what
    lets the range joins below broadcast it."""
    rows = sorted({to_day(d) for d in dates})
    if not rows:
        raise ValueError("at least one snapshot date is needed")
    if len(rows) > MAX_SNAPSHOT_DATES:
        raise ValueError(f"{len(rows)} snapshot dates exceed the broadcast bound {MAX_SNAPSHOT_DATES}")
    return spark.createDataFrame([(d,) for d in rows], "snapshot_date date")


def _in_span(facts: DataFrame, dates: list[str], start_offset: int, end_offset: int) -> DataFrame:
    """Facts within the span of all windows, a plain range test that reaches the parquet scan (below any
    dedupe), so history outside every window is never read."""
    days = sorted(to_day(d) for d in dates)
    return facts.filter(ts_between_midnights(F.col("timestamp"), shift(days[0], start_offset), shift(days[-1], end_offset)))


def _by_window(days: DataFrame, snaps: DataFrame, start_offset: int, end_offset: int) -> DataFrame:
    """Pair each row of a customer's day with each snapshot S whose window ``S+start .. S+end`` holds the day;
    ``_last`` marks the window's last day, of which only midnight counts."""
    s = F.col("snapshot_date")
    ranges = snaps.select(s, (day_number(s) + start_offset).alias("_lo"), (day_number(s) + end_offset).alias("_hi"))
    j = range_join(days, F.col(DAY), ranges, F.col("_lo"), F.col("_hi"), end_offset - start_offset + 1, broadcast_ranges=True)
    return j.withColumn("_last", F.col(DAY) == F.col("_hi")).drop("_lo", "_hi")


def eligible_by_snapshot(customers: DataFrame, dates: list[str], p: Params = DEFAULT) -> DataFrame:
    """B1 for every snapshot: a per-row generator over one literal date list, not a join: output rows are
    exactly the (customer, snapshot) pairs of the result, by the same plan for any number of dates."""
    days = sorted({to_day(d) for d in dates})
    arr = F.array(*[F.lit(d.isoformat()).cast("date") for d in days])
    elig = F.filter(arr, lambda s: F.col("join_date") <= F.date_sub(s, p.minimum_tenure_days))
    return customers.withColumn("snapshot_date", F.explode(elig))


def multi_snapshot_features(spark: SparkSession, customers: DataFrame, transactions: DataFrame,
                            interactions: DataFrame, dates: list[str], p: Params = DEFAULT) -> DataFrame:
    """D4 for a list of snapshot dates; equal to the union of single-date snapshots."""
    states = day_states(_in_span(transactions, dates, -p.feature_window_days, 0),
                        _in_span(interactions, dates, -p.feature_window_days, 0))
    return features_from_states(spark, customers, states, dates, p)


def features_from_states(spark: SparkSession, customers: DataFrame, states: DataFrame, dates: list[str], p: Params = DEFAULT) -> DataFrame:
    """D4 for a list of snapshot dates from customer-day states (a row a customer and day)."""
    s = F.col("snapshot_date")
    keys = ["customer_id", "snapshot_date"]
    seen = _by_window(states, snapshot_frame(spark, dates), -p.feature_window_days, 0)
    age = day_number(s) - F.col(DAY)
    merged = feat.with_all_ratios(seen.groupBy(*keys).agg(*(measure_over(m, fact, age) for m, fact in feat.MEASURES)), *keys)
    base = feat.demographic_features(eligible_by_snapshot(customers, dates, p), s)
    out = feat.derived_features(base.join(merged, keys, "left"))
    return out.select(*[c for c in out.columns if c != "snapshot_date"], "snapshot_date")


def matured_snapshots(historical: DataFrame, as_of: str, p: Params = DEFAULT) -> DataFrame:
    """Distinct snapshot dates at least ``horizon`` days before ``as_of``."""
    s = F.col("snapshot_date").cast("date")
    return (historical.select(s.alias("snapshot_date")).distinct()
            .filter(F.datediff(F.lit(to_day(as_of).isoformat()).cast("date"), F.col("snapshot_date"))
                    >= p.churn_horizon_days))


def backfill_labels(historical: DataFrame, customers: DataFrame, transactions: DataFrame,
                    interactions: DataFrame, as_of: str, p: Params = DEFAULT) -> DataFrame:
    """L2: true labels for every matured snapshot of ``historical``, in one plan.

    The matured snapshot dates are a set of calendar dates: they are fetched
    with a hard row bound (``MAX_SNAPSHOT_DATES``) and become a literal list, so
    the heavy ``historical`` plan runs once and no join against it is needed.
    """
    got = matured_snapshots(historical, as_of, p).limit(MAX_SNAPSHOT_DATES + 1).collect()
    if len(got) > MAX_SNAPSHOT_DATES:
        raise ValueError(f"more than {MAX_SNAPSHOT_DATES} snapshot dates")
    dates = sorted(r.snapshot_date.isoformat() for r in got)
    spark = customers.sparkSession
    if not dates:
        from retention.sources.schemas import LABELS
        return spark.createDataFrame([], LABELS)
    return labels_for_dates(spark, customers, transactions, interactions, dates, p)


def labels_for_dates(spark: SparkSession, customers: DataFrame, transactions: DataFrame,
                     interactions: DataFrame, dates: list[str], p: Params = DEFAULT) -> DataFrame:
    """L1 for a list of snapshot dates in one plan; equal to the union of single-date labels."""
    keys = ["customer_id", "snapshot_date"]
    active = active_days(_in_span(transactions, dates, 1, p.churn_horizon_days),
                         _in_span(interactions, dates, 1, p.churn_horizon_days))
    seen = _by_window(active, snapshot_frame(spark, dates), 1, p.churn_horizon_days)
    elig = eligible_by_snapshot(customers.select("customer_id", "join_date"), dates, p)
    return labels_from_flags(elig, seen.filter(~F.col("_last") | F.col("at_midnight")).select(*keys), keys)
