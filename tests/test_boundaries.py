"""Boundary cases of SURVEY section 1.5 on hand-made frames (FIXTURES.md section 3)."""

from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from retention.operators import features as feat
from retention.operators import labels as lab
from retention.operators import quality as qual
from retention.operators.multisnap import backfill_labels, labels_for_dates, multi_snapshot_features
from retention.sources.schemas import LABELS
from tests.frames import S, S_DAY, customers, day, interactions, transactions


def _snap(spark, c, t, i, s=S):
    return {r.customer_id: r for r in feat.weekly_snapshot(c, t, i, s).collect()}


def test_duplicates_are_removed_and_reported(spark):
    t = transactions(spark, [("a", day(-1))] * 3 + [("a", day(-2))])
    assert qual.clean(t, "transactions").count() == 2
    rep = {(r.check_name): r for r in qual.table_report(t, "transactions", S).collect()}
    assert rep["duplicates"].value == 2 and rep["duplicates"].status == "warn"
    assert rep["row_count"].value == 4


def test_lookback_window_edges(spark):
    c = customers(spark, [("a", date(2020, 1, 1))])
    rows = [("a", day(-90)), ("a", day(-90, -1)), ("a", day(0)), ("a", day(0, 60))]
    r = _snap(spark, c, transactions(spark, rows), interactions(spark, []))["a"]
    # S-90d 00:00 and S 00:00 are in; one second before S-90d and S 00:01 are out.
    assert r.txn_count_90d == 2
    assert r.days_since_last_txn == 0


def test_lookahead_window_edges(spark):
    c = customers(spark, [(x, date(2020, 1, 1)) for x in "abcde"])
    rows = [("a", day(0, 60)), ("b", day(1)), ("c", day(30)), ("d", day(30, 60)), ("e", day(-1))]
    labels = {r.customer_id: r.churn_label for r in
              lab.churn_labels(c, transactions(spark, rows), interactions(spark, []), S).collect()}
    # snapshot day after 00:00 is in neither window; S+30d counts only at exactly midnight.
    assert labels == {"a": 1, "b": 0, "c": 0, "d": 1, "e": 1}


def test_tenure_edges(spark):
    c = customers(spark, [("a", S_DAY - timedelta(days=60)), ("b", S_DAY - timedelta(days=59)), ("n", None)])
    got = {r.customer_id for r in feat.eligible_customers(c, S).collect()}
    assert got == {"a"}


def test_ineligible_but_active_gets_label_zero(spark):
    c = customers(spark, [("young", S_DAY - timedelta(days=10))])
    t = transactions(spark, [("young", day(3))])
    rows = lab.churn_labels(c, t, interactions(spark, []), S).collect()
    assert [(r.customer_id, r.churn_label) for r in rows] == [("young", 0)]
    assert lab.churn_labels(c, t, interactions(spark, []), S, eligible_only=True).count() == 0


def test_session_edges(spark):
    i = interactions(spark, [("a", day(-1), "login", -5), ("b", day(-1), "login", 0),
                             ("c", day(-1), "login", 1), ("d", day(-1), "login", None)])
    got = {r.customer_id: r.session_duration for r in qual.clean(i, "interactions").collect()}
    assert got == {"a": 0, "b": 0, "c": 1, "d": None}
    c = customers(spark, [(x, date(2020, 1, 1)) for x in "abcd"])
    ahead = interactions(spark, [(x, day(2), "login", v) for x, v in zip("abcd", [-5, 0, 1, None])])
    act = {r.customer_id for r in lab.qualifying_activity(transactions(spark, []), ahead, S).collect()}
    assert act == {"c"}


def test_null_keys_raise(spark):
    t = transactions(spark, [(None, day(-1)), ("a", day(-1), None)])
    raw = {"transactions": t}
    with pytest.raises(ValueError, match="null"):
        qual.perform_quality_checks(raw, S)
    # cleaning drops the null amount (amount > 0 is unknown) but, like the
    # reference, not the null key: that is the gate's job.
    assert [r.customer_id for r in qual.clean(t, "transactions").collect()] == [None]


def test_empty_tables(spark):
    c, t, i = customers(spark, []), transactions(spark, []), interactions(spark, [])
    assert feat.weekly_snapshot(c, t, i, S).count() == 0
    rate = lab.churn_rate(lab.churn_labels(c, t, i, S)).first()
    assert rate.total_customers == 0 and rate.churn_rate == 0.0
    nulls = qual.null_report(feat.weekly_snapshot(c, t, i, S)).collect()
    assert all(r.null_ratio == 0.0 for r in nulls)
    empty_hist = spark.createDataFrame([], "snapshot_date date")
    bf = backfill_labels(empty_hist, c, t, i, "2024-02-15")
    assert bf.count() == 0 and bf.schema == LABELS


def test_zero_denominators(spark):
    c = customers(spark, [("a", date(2020, 1, 1))])
    r = _snap(spark, c, transactions(spark, []), interactions(spark, [("a", day(-1), "support", None)]))["a"]
    assert r.login_trend_30d_vs_60d == 0.0 and r.mobile_usage_ratio_30d == 0.0 and r.txn_trend_30d_vs_60d == 0.0
    # never logged in -> 0 after the fill, as the reference
    assert r.days_since_last_login == 0 and r.txn_count_30d == 0


def test_feature_fill_leaves_booleans(spark):
    c = customers(spark, [("a", date(2020, 1, 1), None, True, True, True)])
    r = _snap(spark, c, transactions(spark, []), interactions(spark, []))["a"]
    assert r.has_credit_card is None
    assert r.active_products_count == 0 and r.relationship_score == 0


def test_derived_scores(spark):
    c = customers(spark, [("a", date(2020, 1, 1), True, True, False, False)])
    t = transactions(spark, [("a", day(-1), 2000.0)])
    i = interactions(spark, [("a", day(-1), "login")] * 11 + [("a", day(-2), "mobile"), ("a", day(-3), "web")])
    r = _snap(spark, c, t, i)["a"]
    assert r.relationship_score == 2 * 2 + 1 + 1
    assert r.digital_engagement_score == 13
    assert r.mobile_usage_ratio_30d == 0.5


def test_immature_snapshot_is_not_backfilled(spark):
    c = customers(spark, [("a", date(2020, 1, 1))])
    t = transactions(spark, [("a", day(-1))])
    as_of = "2024-02-14"  # S + 30 days: matured (inclusive)
    hist = spark.createDataFrame([(S_DAY,), (S_DAY + timedelta(days=1),)], "snapshot_date date")
    dates = {r.snapshot_date for r in backfill_labels(hist, c, t, interactions(spark, []), as_of).collect()}
    assert dates == {S_DAY}


def test_multi_snapshot_equals_single(spark):
    c = customers(spark, [("a", date(2020, 1, 1)), ("b", date(2023, 11, 1))])
    rows = [("a", day(k, s)) for k in (-95, -90, -60, -31, -30, -7, 0, 7, 8) for s in (0, 30)]
    rows += [("b", day(k)) for k in (-20, 1, 6)]
    t = transactions(spark, rows)
    i = interactions(spark, [("a", day(k, 5), "login", 3) for k in (-40, -3, 2, 9)])
    dates = ["2024-01-01", "2024-01-08", "2024-01-15", "2024-01-22"]
    multi = multi_snapshot_features(spark, c, t, i, dates)
    single = None
    for s in dates:
        one = feat.weekly_snapshot(c, t, i, s)
        single = one if single is None else single.unionByName(one)
    assert sorted(map(tuple, multi.collect())) == sorted(map(tuple, single.select(*multi.columns).collect()))
    ml = labels_for_dates(spark, c, t, i, dates)
    sl = None
    for s in dates:
        one = lab.churn_labels(c, t, i, s)
        sl = one if sl is None else sl.unionByName(one)
    assert sorted(map(tuple, ml.collect())) == sorted(map(tuple, sl.select(*ml.columns).collect()))


def test_no_future_row_reaches_a_feature(spark):
    c = customers(spark, [("a", date(2020, 1, 1))])
    t = transactions(spark, [("a", day(1), 1e9), ("a", day(0, 1), 1e9), ("a", day(-2), 1.0)])
    r = _snap(spark, c, t, interactions(spark, []))["a"]
    assert r.txn_amount_90d == 1.0


def test_freshness_uses_floored_days(spark):
    t = transactions(spark, [("a", day(-8, 3600))])  # 7 days 23 hours before S
    rep = {r.check_name: r for r in qual.table_report(t, "transactions", S).collect()}
    assert rep["freshness_days"].value == 7 and rep["freshness_days"].status == "ok"


def test_schema_check(spark):
    c = customers(spark, [("a", date(2020, 1, 1))]).drop("gender")
    with pytest.raises(ValueError, match="gender"):
        qual.validate_schemas({"customers": c})
    rows = qual.schema_check({"customers": c.withColumn("age", F.col("age").cast("string"))}).collect()
    age = [r for r in rows if r.column_name == "age"][0]
    assert age.present and not age.type_matches


def test_eligibility_of_a_long_date_list(spark):
    import retention.operators.multisnap as ms
    joined = {"a": date(2023, 10, 1), "b": date(2023, 12, 1), "n": None}
    c = customers(spark, list(joined.items()))
    days = [date(2021, 1, 1) + timedelta(days=k) for k in range(1100)]
    got = ms.eligible_by_snapshot(c, [d.isoformat() for d in days])
    assert sorted(map(tuple, got.select("customer_id", "snapshot_date").collect())) == [
        (k, d) for k in ("a", "b") for d in days if joined[k] <= d - timedelta(days=60)]
    assert "NestedLoop" not in got._jdf.queryExecution().executedPlan().toString()


def test_null_gate_raises_before_fill(spark):
    c = customers(spark, [(x, date(2020, 1, 1)) for x in "abc"])
    t = transactions(spark, [("a", day(-1))])
    unfilled = feat.demographic_features(c, S).join(
        feat.txn_features(feat.historical(t, S), S), "customer_id", "left")
    rep = qual.null_report(unfilled)
    by = {r.feature_name: r for r in rep.collect()}
    assert by["txn_count_30d"].null_count == 2 and by["txn_count_30d"].status == "error"
    with pytest.raises(ValueError, match="txn_count_30d"):
        qual.enforce_null_report(rep)
    # after the fill nothing numeric can fail, as in the reference
    qual.enforce_null_report(qual.null_report(feat.weekly_snapshot(c, t, interactions(spark, []), S)))


def test_split_gate_raises_on_leaking_frames(spark):
    from retention.operators import split as sp
    rows = [(f"id{i}", "2024-01-15") for i in range(50)] + [(f"id{i}", "2024-01-01") for i in range(50)]
    df = spark.createDataFrame(rows, "customer_id string, snapshot_date string").withColumn(
        "snapshot_date", F.col("snapshot_date").cast("date"))
    train, val = sp.split(df, "2024-01-08")
    sp.enforce_split(sp.split_report(train, val))
    # a split date after every snapshot leaves no validation rows: still ordered
    assert sp.split_report(*sp.split(df, "2024-02-01")).first().status == "ok"
    shared = val.limit(1)
    leak = sp.split_report(train.unionByName(shared.withColumn("snapshot_date", F.lit("2024-01-01").cast("date"))), val)
    assert leak.first().overlap_customers == 1
    with pytest.raises(ValueError, match="leakage"):
        sp.enforce_split(leak)
    late = train.withColumn("snapshot_date", F.lit("2024-01-20").cast("date"))
    with pytest.raises(ValueError, match="leakage"):
        sp.enforce_split(sp.split_report(late, val))


def test_split_prunes_the_partitions_of_a_stored_table(spark, tmp_path):
    from retention.operators import split as sp
    df = spark.createDataFrame([(f"id{i}", d, 1) for i in range(20) for d in ("2024-01-01", "2024-01-15")],
                               "customer_id string, snapshot_date string, x int")
    df.withColumn("snapshot_date", F.col("snapshot_date").cast("date")).write.partitionBy("snapshot_date").parquet(str(tmp_path / "t"))
    for side in sp.split(spark.read.parquet(str(tmp_path / "t")), "2024-01-08"):
        plan = side._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: [isnotnull(snapshot_date" in plan


@pytest.mark.parametrize("ratio", [0.001, 0.7, 0.999])
def test_split_ratio_is_exact_for_any_fraction(spark, ratio):
    from retention.functions.hashing import split_predicate
    n = 100_000
    got = spark.range(n).filter(split_predicate(F.col("id"), ratio)).count()
    assert abs(got - ratio * n) < 5 * (ratio * (1 - ratio) * n) ** 0.5 + 1


def test_null_score_lowers_recall_and_fails_the_gate(spark):
    from retention.operators import ranking
    rows = [(0.9, 1, 1), (0.2, 0, 0), (None, 1, None)]
    df = spark.createDataFrame(rows, "churn_probability double, churn_label int, churn_prediction int")
    m = ranking.metrics(df, 0.5)
    one = m.first()
    assert (one.n_rows, one.n_unscored, one.recall, one.auc) == (3, 1, 0.5, 1.0)
    assert ranking.prf(df).first().recall == 0.5
    assert {r.status for r in ranking.threshold_gate(m, 0.0, 0.0).collect()} == {"error"}
