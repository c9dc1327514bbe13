"""Feature store round trip, dynamic overwrite, pruning; range join; stream scoring; profile edges."""

from datetime import date, datetime, timedelta

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from retention.operators.customer360 import event_pivot, lifecycle
from retention.operators.rangejoin import range_join
from retention.operators.scoring import linear_score
from retention.session import scratch_path
from retention.sources.store import FeatureStore
from retention.streaming.scoring import score_stream


def _feats(spark, dates, n=3):
    rows = [(f"c{i}", d, i * 1, 1, 0, 0, 5) for d in dates for i in range(n)]
    df = spark.createDataFrame(rows, "customer_id string, snapshot_date string, txn_count_30d int, "
                                     "login_count_30d int, days_since_last_txn int, active_products_count int, "
                                     "support_interactions_30d int")
    return df.withColumn("snapshot_date", F.col("snapshot_date").cast("date"))


def test_store_roundtrip_and_dynamic_overwrite(spark):
    st_ = FeatureStore(spark, scratch_path(spark, "test-store"))
    st_.store_features(_feats(spark, ["2024-01-01", "2024-01-08"]))
    st_.store_features(_feats(spark, ["2024-01-08"], n=5))  # replaces only 01-08
    assert st_.load_features("2024-01-01").count() == 3
    assert st_.load_features("2024-01-08").count() == 5
    rng = st_.load_features_range("2024-01-02", "2024-01-31")
    assert rng.count() == 5
    plan = rng._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "snapshot_date" in plan
    st_.store_labels(spark.createDataFrame([("c0", 1, None, date(2024, 1, 1))],
                                           "customer_id string, churn_label int, churned_date date, snapshot_date date"))
    assert st_.load_labels_range("2024-01-01", "2024-01-01").count() == 1


@settings(max_examples=12, deadline=None)
@given(st.lists(st.integers(0, 60), min_size=1, max_size=25),
       st.lists(st.tuples(st.integers(0, 60), st.integers(0, 20)), min_size=1, max_size=6),
       st.integers(1, 15), st.sampled_from([(True, None), (False, 1), (False, 4)]))
def test_range_join_matches_bruteforce(spark, points, ranges, bucket, mode):
    pts = spark.createDataFrame([(i, p) for i, p in enumerate(points)], "pid int, p int")
    rgs = spark.createDataFrame([(j, lo, lo + w) for j, (lo, w) in enumerate(ranges)], "rid int, lo int, hi int")
    joined = range_join(pts, F.col("p"), rgs, F.col("lo"), F.col("hi"), bucket, broadcast_ranges=mode[0], salt=mode[1])
    got = sorted((r.pid, r.rid) for r in joined.collect())
    want = sorted((i, j) for i, p in enumerate(points) for j, (lo, w) in enumerate(ranges) if lo <= p <= lo + w)
    assert got == want


def test_stream_scoring_equals_batch(spark):
    src, out, ck = (scratch_path(spark, x) for x in ("t-in", "t-out", "t-ck"))
    feats = _feats(spark, ["2024-01-01", "2024-01-08"])
    feats.write.mode("overwrite").parquet(src)
    q = score_stream(spark, src, feats.schema, lambda d: linear_score(d, "2024-02-15"), out, ck)
    q.awaitTermination()
    got = sorted(map(tuple, spark.read.parquet(out).collect()))
    want = sorted(map(tuple, linear_score(feats, "2024-02-15").collect()))
    assert got == want


def test_lifecycle_bucket_edges(spark):
    end = date(2024, 1, 31)
    rows = [(f"d{d}", datetime.combine(end - timedelta(days=d), datetime.min.time())) for d in (14, 15, 44, 45, 59, 60)]
    rows.append(("never", None))
    last = spark.createDataFrame(rows, "customer_id string, last_activity timestamp_ntz")
    got = {r.customer_id: r.lifecycle_state for r in lifecycle(last, "2024-01-31").collect()}
    assert got == {"d14": "active", "d15": "dormant", "d44": "dormant", "d45": "at-risk", "d59": "at-risk",
                   "d60": "lost", "never": "lost"}


def test_event_pivot_fills_zero(spark):
    ev = spark.createDataFrame([("a", "click"), ("a", "click"), ("b", "view"), ("c", "refund"), ("c", None)], "customer_id string, event_type string")
    got = {r.customer_id: r.asDict() for r in event_pivot(ev).collect()}
    assert got["a"]["click"] == 2 and got["a"]["view"] == 0 and got["b"]["purchase"] == 0
    assert got["c"]["other"] == 2 and got["a"]["other"] == 0


def test_export_truncates_to_millis_and_drops(spark):
    from retention.sources.raw import export_parquet
    df = spark.createDataFrame([("a", datetime(2024, 1, 1, 0, 0, 0, 123456), 1)],
                               "customer_id string, timestamp timestamp_ntz, extra int")
    path = scratch_path(spark, "t-export")
    export_parquet(df, path, drop=("extra",), millis="timestamp")
    back = spark.read.parquet(path)
    assert back.columns == ["customer_id", "timestamp"]
    assert back.first().timestamp == datetime(2024, 1, 1, 0, 0, 0, 123000)


def test_profile_report_runs(spark):
    from retention.operators.profile import profile_report
    from retention.sources import fixtures as fx
    from tests.conftest import SF_SMALL
    t = fx.tables(spark, SF_SMALL)
    rep = profile_report(t.customers, t.transactions, t.interactions, "2024-01-31", 2023)
    assert all(df.count() > 0 for df in rep.values())


def test_stream_restart_scores_each_file_once(spark):
    src, out, ck = (scratch_path(spark, x) for x in ("r-in", "r-out", "r-ck"))
    first = _feats(spark, ["2024-01-01"])
    first.write.mode("append").parquet(src)
    scorer = lambda d: linear_score(d, "2024-02-15")
    score_stream(spark, src, first.schema, scorer, out, ck).awaitTermination()
    second = _feats(spark, ["2024-01-08"], n=4)
    second.write.mode("append").parquet(src)
    # a new query on the same checkpoint picks up only the new file
    score_stream(spark, src, first.schema, scorer, out, ck).awaitTermination()
    got = spark.read.parquet(out)
    assert got.count() == 3 + 4
    assert got.select("customer_id", "snapshot_date").distinct().count() == 7


def test_store_files_per_date_bounds_file_count(spark):
    import os
    root = scratch_path(spark, "t-files")
    st_ = FeatureStore(spark, root)
    st_.store_features(_feats(spark, ["2024-01-01", "2024-01-08"], n=40).repartition(12), files_per_date=2)
    base = st_.features_root.replace("file:", "")
    for d in ("2024-01-01", "2024-01-08"):
        files = [f for f in os.listdir(f"{base}/snapshot_date={d}") if f.endswith(".parquet")]
        assert 1 <= len(files) <= 2
    assert st_.load_features_range("2024-01-01", "2024-01-08").count() == 80
