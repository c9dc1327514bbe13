"""The driver contract: entry(), queries(), oracle_sql()."""

import __spark_entry__ as E


def test_entry_runs(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert "customer_id" in df.columns and "snapshot_date" in df.columns
    assert df.schema == E.entry(spark).schema


def test_oracle_keys_are_queries():
    assert set(E.oracle_sql()) <= set(E.queries())
    assert len(E.queries()) >= 55


def test_rows_only_queries_are_the_non_sql_ones():
    from retention.plans import catalog
    assert set(catalog.QUERIES) - set(catalog.ORACLE) == {"segments", "segment_rules", "gbt_train_score", "gbt_tree_shap"}
