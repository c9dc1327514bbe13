"""Histogram boosting against trees grown by brute force on a small table."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest

from retention.operators import boosting as B
from retention.operators.treeshap import margin

COLUMNS = ["a", "b", "c"]


def small(spark, n=300, seed=1):
    r = random.Random(seed)
    rows = []
    for i in range(n):
        a, b, c = r.randrange(12), round(r.random(), 2), r.choice([0, 1])
        y = int(r.random() < 1 / (1 + math.exp(-(a - 6 + 3 * c * b))))
        rows.append((f"k{i}", "2024-01-01", float(a) if i % 17 else None, b, bool(c), y if i % 50 else None))
    return spark.createDataFrame(rows, "customer_id string, snapshot_date string, a double, b double, c boolean, churn_label int"), rows


def brute(rows, cuts, p: B.BoostParams, sampled=None):
    """Trees as nested tuples, by trying every threshold on raw values."""
    data = [([0.0 if v is None else float(v) for v in r[2:5]], float(r[5])) for r in rows if r[5] is not None]
    x, y = np.array([d[0] for d in data]), np.array([d[1] for d in data])
    m = np.full(len(y), math.log(p.base_score / (1 - p.base_score)))
    trees = []
    for number in range(p.rounds):
        pr = 1 / (1 + np.exp(-m))
        g, h = np.rint((pr - y) * 2**26) / 2**26, np.rint(pr * (1 - pr) * 2**26) / 2**26
        rows_in = np.ones(len(y), bool) if sampled is None else sampled(number)
        used = B.tree_columns(p, number, 3)

        def grow(here, depth):
            G, H = g[here].sum(), h[here].sum()
            leaf = ("leaf", -G / (H + p.reg_lambda))
            best = (1e-12, None)
            for f in used if depth else []:
                for cut in cuts[f]:
                    left, right = here & (x[:, f] <= cut), here & (x[:, f] > cut)
                    if h[left].sum() < p.min_child_weight or h[right].sum() < p.min_child_weight:
                        continue
                    gain = sum(g[s].sum() ** 2 / (h[s].sum() + p.reg_lambda) for s in (left, right)) - G**2 / (H + p.reg_lambda)
                    if gain > best[0] + 1e-9:
                        best = (gain, (f, cut))
            if best[1] is None:
                return leaf
            f, cut = best[1]
            return (f, cut, grow(here & (x[:, f] <= cut), depth - 1), grow(here & (x[:, f] > cut), depth - 1))

        tree = grow(rows_in, p.max_depth)
        trees.append(tree)

        def value(t, v):
            while t[0] != "leaf":
                t = t[2] if v[t[0]] <= t[1] else t[3]
            return t[1]

        m = m + p.learning_rate * np.array([value(tree, v) for v in x])
    return trees, m


def nested(t, node=0):
    if t.feature[node] < 0:
        return ("leaf", t.value[node])
    return (int(t.feature[node]), float(t.threshold[node]), nested(t, t.left[node]), nested(t, t.right[node]))


def same(a, b):
    assert a[0] == b[0]
    if a[0] == "leaf":
        assert a[1] == pytest.approx(b[1], abs=1e-6)
    else:
        assert a[1] == b[1]
        same(a[2], b[2])
        same(a[3], b[3])


def test_trees_equal_brute_force(spark):
    df, rows = small(spark)
    p = B.BoostParams(rounds=4, max_depth=3, row_sample=1.0, column_sample=0.7, checkpoint_interval=2)
    model = B.fit(df.repartition(5), COLUMNS, p=p)
    want, m = brute(rows, model.cuts, p)
    for t, w in zip(model.trees, want, strict=True):
        same(nested(t), w)
    got = {r.customer_id: r.margin for r in B.with_margin(model, df).collect()}
    labelled = [r[0] for r in rows if r[5] is not None]
    assert [got[k] for k in labelled] == pytest.approx(list(m), abs=1e-6)


def test_same_model_under_any_partitioning_and_after_reload(spark, tmp_path):
    df, _ = small(spark)
    p = B.BoostParams(rounds=3, max_depth=4, checkpoint_interval=2)
    one, two = (B.fit(df.repartition(n), COLUMNS, p=p) for n in (1, 9))
    tables = [sorted(map(tuple, B.node_table(spark, m).collect())) for m in (one, two)]
    assert tables[0] == tables[1] and len(tables[0]) > 9
    B.save(spark, one, str(tmp_path / "m"))
    again = B.load(spark, str(tmp_path / "m"))
    assert sorted(map(tuple, B.node_table(spark, again).collect())) == tables[0]
    scored = [sorted(map(tuple, B.predict(m, df, "2024-02-01").collect())) for m in (one, again)]
    assert scored[0] == scored[1]


def test_rows_and_columns_are_sampled_per_tree():
    key = np.random.default_rng(0).integers(-2**62, 2**62, 20_000)
    one, two = B._uniform(key, 0) < 0.8, B._uniform(key, 1) < 0.8
    assert abs(one.mean() - 0.8) < 0.02 and abs((one & two).mean() - 0.64) < 0.02
    p = B.BoostParams()
    drawn = [tuple(B.tree_columns(p, t, 10)) for t in range(20)]
    assert {len(d) for d in drawn} == {8} and len(set(drawn)) > 5 and drawn == [tuple(B.tree_columns(p, t, 10)) for t in range(20)]


def test_learns_what_separates(spark):
    df, rows = small(spark, 400, 2)
    model = B.fit(df, COLUMNS, p=B.BoostParams(rounds=10, max_depth=3))
    x = np.array([[0.0 if v is None else float(v) for v in r[2:5]] for r in rows])
    y = np.array([-1 if r[5] is None else r[5] for r in rows])
    m = margin(model.trees, x)
    pos, neg = m[y == 1], m[y == 0]
    assert (pos[:, None] > neg[None, :]).mean() > 0.8


def test_empty_and_constant_tables(spark):
    df, _ = small(spark, 5)
    empty = B.fit(df.limit(0), COLUMNS, p=B.BoostParams(rounds=2))
    assert empty.trees == [] and B.predict(empty, df, "2024-01-01").select("churn_probability").distinct().first()[0] == 0.5
    flat = spark.createDataFrame([(str(i), "d", 1.0, 1.0, True, i % 2) for i in range(20)], df.schema)
    model = B.fit(flat, COLUMNS, p=B.BoostParams(rounds=2))
    assert all(len(t.left) == 1 for t in model.trees)
