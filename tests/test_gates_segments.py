"""Gates observed in the pass that writes, and the rules and effect sizes that explain segments."""

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from retention.operators import quality, segments
from retention.session import scratch_path
from retention.sources import fixtures as fx
from tests.conftest import SF_SMALL

AS_OF = "2024-02-15"


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_observed_reports_and_cleaning(spark):
    raw = fx.tables(spark, SF_SMALL).as_dict()
    raw["transactions"] = raw["transactions"].unionByName(raw["transactions"].limit(30))
    raw["interactions"] = raw["interactions"].limit(0)
    report, clean = quality.clean_with_gates(raw, AS_OF)
    assert rows(report) == rows(quality.quality_report(raw, AS_OF))
    for name, df in raw.items():
        want = quality.clean(df, name)
        assert clean[name].schema.names == want.schema.names
        assert rows(clean[name]) == rows(want), name


def test_observed_gate_raises(spark):
    t = fx.tables(spark, SF_SMALL).transactions
    broken = t.limit(3).withColumn("customer_id", F.lit(None).cast("string"))
    raw = {"transactions": t.limit(10).unionByName(broken)}
    with pytest.raises(ValueError, match="transactions.customer_id=3"):
        quality.clean_with_gates(raw, AS_OF)
    report, _ = quality.clean_with_gates(raw, AS_OF, raise_on_error=False)
    assert rows(report) == rows(quality.quality_report(raw, AS_OF))


@pytest.mark.parametrize("n", [0, 40])
def test_observed_null_report(spark, n):
    df = spark.range(n).select(F.col("id").alias("customer_id"), F.when(F.col("id") % 3 > 0, 1).alias("a"), F.lit(None).cast("double").alias("b"))
    kept, report = quality.write_with_null_report(df, scratch_path(spark, "t-nulls"))
    assert rows(report) == rows(quality.null_report(df)) and rows(kept) == rows(df)


@pytest.fixture(scope="module")
def grouped(spark):
    r = np.random.default_rng(5)
    segment = r.integers(0, 3, 400)
    a = np.where(segment == 0, r.normal(0, 1, 400), r.normal(9, 1, 400))
    b = np.where(segment == 1, r.normal(-5, 2, 400), r.normal(5, 2, 400))
    data = [(int(s), float(x), float(y), None if i % 9 == 0 else 1) for i, (s, x, y) in enumerate(zip(segment, a, b))]
    return spark.createDataFrame(data + [(7, 100.0, None, None)], "segment int, a double, b double, c int").cache()


def test_rules_of_segments_in_another_engine(spark, grouped):
    columns = ["a", "b", "c"]
    tree = segments.fit_segment_tree(grouped, columns)
    rules = segments.leaf_rules(tree, columns, scratch_path(spark, "t-tree"))
    assert 3 <= len(rules) <= 8
    assert segments.with_rule(grouped, rules).where("rule_id is null").count() == 0
    table = grouped.toPandas()  # noqa: F841
    sizes = dict(duckdb.sql("SELECT segment, count(*) FROM table GROUP BY 1".replace("table", '"table"')).fetchall())
    found = segments.rule_report(grouped, rules).collect()
    assert sum(r.support for r in found) == 401
    for r in found:
        inside = duckdb.sql(f'SELECT segment, count(*) AS n FROM "table" WHERE {r.rule} GROUP BY 1 ORDER BY n DESC, segment').fetchall()
        assert (r.support, r.segment, r.matching) == (sum(n for _, n in inside), *inside[0])
        assert r.purity == pytest.approx(r.matching / r.support) and r.coverage == pytest.approx(r.matching / sizes[r.segment])
    assert sum(r.matching for r in found) > 380


def test_rule_of_a_single_segment(spark, grouped):
    one = grouped.where("segment = 7")
    rules = segments.leaf_rules(segments.fit_segment_tree(one, ["a"]), ["a"], scratch_path(spark, "t-tree"))
    assert rules == ["TRUE"]
    assert [tuple(r)[2:] for r in segments.rule_report(one, rules).collect()] == [(7, 1, 1, 1.0, 1.0)]


def test_effect_sizes(grouped):
    columns = ["a", "b", "c"]
    found = {(r.segment, r.feature): r for r in segments.segment_effects(grouped, columns).collect()}
    table = grouped.toPandas()
    assert len(found) == 12
    for (segment, feature), r in found.items():
        own = table[table.segment == segment]
        inside, outside = own[feature].dropna().to_numpy(float), table[table.segment != segment][feature].dropna().to_numpy(float)
        assert r.customers == len(own)
        assert r.mean_inside == (pytest.approx(inside.mean()) if len(inside) else None)
        assert r.mean_outside == pytest.approx(outside.mean())
        pooled = np.sqrt((inside.size * inside.var() + outside.size * outside.var()) / (inside.size + outside.size - 2)) if len(inside) else 0
        want = pytest.approx((inside.mean() - outside.mean()) / pooled) if pooled > 0 else None
        assert r.effect_size == want, (segment, feature)
