"""Events as a stream: repeats dropped, day states kept, features and scores equal to the batch plan's."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from retention.operators import features, quality
from retention.operators.scoring import linear_score
from retention.streaming.events import EventFeatures, event_stream
from tests.frames import customers, interactions, transactions
from tests.test_daystate import fact_rows


def setup(spark, folder, parts=3):
    """Raw rows, some repeated, in files by time; returns (customers, all transactions, all interactions, streams)."""
    tx, it = fact_rows(200)
    tx, it = sorted(tx, key=lambda r: r[1]), sorted(it, key=lambda r: r[1])
    tx, it = sorted(tx + tx[::7], key=lambda r: r[1]), sorted(it + it[::5] + it[::10], key=lambda r: r[1])
    it = [(c, t, k, -3 if v == 5 else v) for c, t, k, v in it]
    streams = []
    for name, make, rows in (("transactions", transactions, tx), ("interactions", interactions, it)):
        for k in range(parts):
            begin, end = (dt.datetime(2023, 9, 1) + dt.timedelta(days=160 * x // parts) for x in (k, k + 1))
            make(spark, [r for r in rows if begin <= r[1] < end]).coalesce(1).write.mode("append").parquet(f"{folder}/{name}")
        streams.append(event_stream(spark, f"{folder}/{name}", make(spark, rows[:1]).schema))
    c = customers(spark, [(f"c{k}", dt.date(2020, 1, 1 + k)) for k in range(7)])
    return c, transactions(spark, tx), interactions(spark, it), streams


def as_set(df):
    return sorted(map(tuple, df.collect()), key=str)


def batch(c, t, i, day):
    return features.weekly_snapshot(c, quality.clean(t, "transactions"), quality.clean(i, "interactions"), day)


def test_last_state_equals_the_batch_plan(spark, tmp_path):
    c, t, i, streams = setup(spark, str(tmp_path))
    events = EventFeatures(spark, str(tmp_path / "state"))
    query = events.start(*streams, customers=c, scorer=lambda f: linear_score(f, "2024-03-01"))
    query.awaitTermination()
    assert query.exception() is None
    for day in ("2024-02-08", "2024-01-15"):
        want = batch(c, t, i, day)
        assert as_set(events.features(c, day).select(*want.columns)) == as_set(want)
    compact = events.compact("2023-10-01")
    want = batch(c, t, i, "2024-02-08")
    assert as_set(compact.features(c, "2024-02-08").select(*want.columns)) == as_set(want)
    assert compact.states().count() < events.states().count()
    scores = spark.read.parquet(f"{events.folder}/scores")
    last = scores.where(F.col("batch") == scores.agg(F.max("batch")).first()[0]).drop("batch")
    day = last.first().snapshot_date.isoformat()
    want = linear_score(batch(c, t, i, day), "2024-03-01").join(last.select("customer_id"), "customer_id", "left_semi")
    assert as_set(last.select(*want.columns)) == as_set(want) and last.count() > 0


def test_a_restart_goes_on_where_it_was(spark, tmp_path):
    c, t, i, streams = setup(spark, str(tmp_path))
    events = EventFeatures(spark, str(tmp_path / "state"))
    events.start(*streams).awaitTermination()
    before = as_set(events.states())
    more = transactions(spark, [("c1", dt.datetime(2024, 2, 7, 12), 40.0, "checking", "deposit")] * 2)
    more.coalesce(1).write.mode("append").parquet(f"{tmp_path}/transactions")
    interactions(spark, [("c2", dt.datetime(2024, 2, 8), "login", 5)]).coalesce(1).write.mode("append").parquet(f"{tmp_path}/interactions")
    events.start(*streams).awaitTermination()
    assert len(as_set(events.states())) >= len(before)
    want = batch(c, t.union(more), i.union(interactions(spark, [("c2", dt.datetime(2024, 2, 8), "login", 5)])), "2024-02-08")
    assert as_set(events.features(c, "2024-02-08").select(*want.columns)) == as_set(want)
