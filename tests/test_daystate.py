"""Customer-day states: one row a customer and day, mergeable, with the features of any window."""

from __future__ import annotations

import datetime as dt
import random

from pyspark.sql import functions as F

from retention.operators import daystate, features
from retention.operators.multisnap import multi_snapshot_features
from tests.frames import customers, interactions, transactions


def fact_rows(n=300):
    r = random.Random(3)
    start = dt.datetime(2023, 9, 1)

    def when():
        return start + dt.timedelta(days=r.randrange(160), seconds=r.choice([0, 0, 1, 43200, 86399]))

    tx = [(f"c{r.randrange(6)}", when(), r.choice([10.0, 250.5, 4000.0, None]), r.choice(["checking", "savings", "credit_card", "loan", None]),
           r.choice(["deposit", "withdrawal", "fee", "transfer"])) for _ in range(n)]
    it = [(f"c{r.randrange(6)}", when(), r.choice(["login", "support", "mobile", "web", "atm"]), r.choice([0, 5, 60, None])) for _ in range(n)]
    return tx, it


def as_set(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_one_row_a_customer_and_day(spark):
    tx, it = fact_rows()
    states = daystate.day_states(transactions(spark, tx), interactions(spark, it))
    want = {(c, (t - dt.datetime(1970, 1, 1)).days) for c, t, *_ in tx + it}
    got = [(r.customer_id, r.day) for r in states.collect()]
    assert len(got) == len(want) and set(got) == want
    midnight = {(c, t) for c, t, *_ in tx if t.time() == dt.time()}
    assert states.agg(F.sum("t_count_0")).first()[0] == sum(t.time() == dt.time() for _, t, *_ in tx) >= len(midnight)


def test_states_of_parts_merge_to_those_of_all(spark):
    tx, it = fact_rows()
    parts = [daystate.day_states(transactions(spark, tx[i::3]), interactions(spark, it[i::3])) for i in range(3)]
    merged = daystate.merge_days(parts[0].unionByName(parts[1]).unionByName(parts[2]))
    whole = daystate.day_states(transactions(spark, tx), interactions(spark, it))
    assert as_set(merged.select(*whole.columns)) == as_set(whole)  # the amounts add up exactly


def test_many_dates_equal_single_dates(spark):
    tx, it = fact_rows()
    c, t, i = customers(spark, [(f"c{k}", dt.date(2020, 1, 1 + k)) for k in range(7)]), transactions(spark, tx), interactions(spark, it)
    dates = ["2023-11-30", "2023-12-01", "2024-01-15", "2024-02-08", "2025-01-01"]
    many = multi_snapshot_features(spark, c, t, i, dates)
    single = [tuple(r) for d in dates for r in features.weekly_snapshot(c, t, i, d).select(*many.columns).collect()]
    assert as_set(many) == sorted(single, key=str)


def test_facts_are_not_copied_before_they_are_combined(spark):
    tx, it = fact_rows(5)
    c, t, i = customers(spark, [("c1", dt.date(2020, 1, 1))]), transactions(spark, tx), interactions(spark, it)
    plan = multi_snapshot_features(spark, c, t, i, ["2024-01-08", "2024-01-15"])._jdf.queryExecution().optimizedPlan().toString()
    join = plan.index("_rj_bucket")
    assert plan.count("_rj_bucket") and plan.index("count(CASE", join) > join  # the states' aggregate lies below the range join
