"""The registered queries: one callable per operator group, (spark, sf_dir) -> DataFrame.

Every query reads the driver's tables through the fixture views, over whole
tables, so its work grows with the data. ``ORACLE`` holds the DuckDB text of
the same result for the side-by-side check; both sides go through the same
output shaping (``tidy`` / ``tidy_sql``).

Sections, in order: cleaning; quality; features; labels; many snapshots;
sources and store; training set and split; scoring and metrics; drift and
attributions; profile; customer 360; Spark ML; second tier and streaming.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from retention.functions.hashing import HEX_DIGITS, hex_threshold
from retention.operators import features as feat
from retention.operators import labels as lab
from retention.operators import quality as qual
from retention.params import DEFAULT
from retention.plans import oracle as O
from retention.plans.tidy import tidy, tidy_sql
from retention.sources import fixtures as fx

# The demo snapshot and as-of date of the reference's main flow.
SNAPSHOT = "2024-01-15"
AS_OF = "2024-02-15"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

MONEY = ["txn_amount_30d", "txn_amount_60d", "txn_amount_90d"]
DATES = ["join_date", "snapshot_date"]
FEATURE_INTS = [c for c in O.NUMERIC_FILL if c not in feat.DOUBLE_FEATURES]
FEATURE_DBLS = [c for c in feat.DOUBLE_FEATURES if c not in MONEY]


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def raw(spark: SparkSession, sf: str) -> fx.Tables:
    return fx.tables(spark, sf)


def cleaned(spark: SparkSession, sf: str) -> fx.Tables:
    t = raw(spark, sf)
    return fx.Tables(t.customers.distinct(), qual.clean(t.transactions, "transactions"),
                     qual.clean(t.interactions, "interactions"))


def snapshot_df(spark: SparkSession, sf: str, s: str = SNAPSHOT) -> DataFrame:
    t = cleaned(spark, sf)
    return feat.weekly_snapshot(t.customers, t.transactions, t.interactions, s)


# ---------------------------------------------------------------- cleaning

@query("clean_transactions", tidy_sql(O.with_views(
    "SELECT * FROM (SELECT DISTINCT * FROM (SELECT * FROM transactions UNION ALL SELECT * FROM transactions)) "
    "WHERE amount > 0"), money=["amount"], dates=["timestamp"]))
def q_clean_transactions(spark, sf):
    t = raw(spark, sf).transactions
    return tidy(qual.clean(t.unionByName(t), "transactions"), money=["amount"])


@query("clean_interactions", tidy_sql(O.with_views(
    "SELECT customer_id, interaction_type, timestamp, CASE WHEN session_duration < 0 THEN 0 "
    "ELSE session_duration END AS session_duration FROM (SELECT DISTINCT * FROM "
    "(SELECT * FROM interactions UNION ALL SELECT * FROM interactions))"),
    ints=["session_duration"], dates=["timestamp"]))
def q_clean_interactions(spark, sf):
    t = raw(spark, sf).interactions
    return tidy(qual.clean(t.unionByName(t), "interactions"))


# ---------------------------------------------------------------- quality

def _quality_sql(table: str, crit: list[str], fresh: bool, as_of: str) -> str:
    cols = {"customers": "customer_id, age, state, has_credit_card, has_loan, has_checking, has_savings, "
                         "join_date, gender",
            "transactions": "customer_id, product, amount, txn_type, timestamp",
            "interactions": "customer_id, interaction_type, timestamp, session_duration"}[table]
    aggs = ["sum(_n) AS total", "count(*) AS distinct_rows"]
    aggs += [f"coalesce(sum(_n) FILTER (WHERE {c} IS NULL), 0) AS null_{c}" for c in crit]
    if fresh:
        aggs.append("max(timestamp) AS latest")
    a = f"SELECT {', '.join(aggs)} FROM (SELECT {cols}, count(*) AS _n FROM {table} GROUP BY ALL)"
    rows = [f"SELECT '{table}' AS table_name, 'row_count' AS check_name, CAST(NULL AS VARCHAR) AS column_name, "
            f"CAST(coalesce(total, 0) AS BIGINT) AS value, 'ok' AS status FROM a_{table}",
            f"SELECT '{table}', 'duplicates', NULL, CAST(coalesce(total, 0) - distinct_rows AS BIGINT), "
            f"CASE WHEN coalesce(total, 0) - distinct_rows > 0 THEN 'warn' ELSE 'ok' END FROM a_{table}"]
    for c in crit:
        rows.append(f"SELECT '{table}', 'critical_nulls', '{c}', CAST(null_{c} AS BIGINT), "
                    f"CASE WHEN null_{c} > 0 THEN 'error' ELSE 'ok' END FROM a_{table}")
    if fresh:
        age = (f"(date_diff('day', CAST(latest AS DATE), DATE '{as_of}') - "
               "CASE WHEN CAST(CAST(latest AS DATE) AS TIMESTAMP) < latest THEN 1 ELSE 0 END)")
        rows.append(f"SELECT '{table}', 'freshness_days', 'timestamp', CAST({age} AS BIGINT), "
                    f"CASE WHEN {age} > 7 THEN 'warn' ELSE 'ok' END FROM a_{table}")
    return a, " UNION ALL ".join(rows)


def _quality_report_sql() -> str:
    from retention.sources.schemas import CRITICAL_COLUMNS
    extra, parts = {}, []
    for t in ("customers", "transactions", "interactions"):
        a, body = _quality_sql(t, CRITICAL_COLUMNS[t], t != "customers", AS_OF)
        extra[f"a_{t}"] = a
        parts.append(body)
    return O.with_views(" UNION ALL ".join(parts), extra)


@query("quality_report", _quality_report_sql())
def q_quality_report(spark, sf):
    return tidy(qual.quality_report(raw(spark, sf).as_dict(), AS_OF))


@query("quality_report_observed", _quality_report_sql())
def q_quality_report_observed(spark, sf):
    """I1-I3, D5-D7 as metrics of the pass that cleans each table."""
    return tidy(qual.clean_with_gates(raw(spark, sf).as_dict(), AS_OF, raise_on_error=False)[0])


def _schema_check_sql() -> str:
    from retention.sources.schemas import EXPECTED
    declared = ", ".join(f"('{t}', '{f.name}', '{f.dataType.simpleString()}')"
                         for t, sch in EXPECTED.items() for f in sch.fields)
    actual = " UNION ALL ".join(f"SELECT '{t}' AS table_name, column_name, column_type FROM (DESCRIBE SELECT * FROM {t})"
                                for t in EXPECTED)
    mapped = ("SELECT table_name, column_name, CASE column_type WHEN 'VARCHAR' THEN 'string' WHEN 'INTEGER' THEN 'int' "
              "WHEN 'BIGINT' THEN 'bigint' WHEN 'DOUBLE' THEN 'double' WHEN 'BOOLEAN' THEN 'boolean' "
              "WHEN 'DATE' THEN 'date' WHEN 'TIMESTAMP' THEN 'timestamp_ntz' ELSE lower(column_type) END AS actual_type "
              f"FROM ({actual})")
    return O.with_views(
        "SELECT d.table_name, d.column_name, d.declared_type, m.actual_type, m.actual_type IS NOT NULL AS present, "
        "coalesce(m.actual_type = d.declared_type, false) AS type_matches "
        f"FROM (VALUES {declared}) AS d(table_name, column_name, declared_type) "
        f"LEFT JOIN ({mapped}) m ON d.table_name = m.table_name AND d.column_name = m.column_name")


@query("schema_check", _schema_check_sql())
def q_schema_check(spark, sf):
    return qual.schema_check(raw(spark, sf).as_dict())


# ---------------------------------------------------------------- features

@query("eligible_customers", tidy_sql(O.with_views(O.eligible(SNAPSHOT)), ints=["age"], dates=["join_date"]))
def q_eligible(spark, sf):
    return tidy(feat.eligible_customers(raw(spark, sf).customers, SNAPSHOT))


@query("feat_demographic", tidy_sql(O.with_views(O.demographic(O.eligible(SNAPSHOT), SNAPSHOT)),
                                    ints=["age", "tenure_days", "active_products_count"], dates=["join_date"]))
def q_feat_demographic(spark, sf):
    return tidy(feat.demographic_features(feat.eligible_customers(raw(spark, sf).customers, SNAPSHOT), SNAPSHOT))


_TXN_INTS = [c for c in feat.TXN_FEATURES if c not in feat.DOUBLE_FEATURES]


@query("feat_txn", tidy_sql(O.with_views(O.txn_features(SNAPSHOT)), money=MONEY,
                            dbl=["avg_txn_amount_30d", "txn_trend_30d_vs_60d"], ints=_TXN_INTS))
def q_feat_txn(spark, sf):
    t = cleaned(spark, sf).transactions
    return tidy(feat.txn_features(feat.historical(t, SNAPSHOT), SNAPSHOT), money=MONEY)


_INT_INTS = [c for c in feat.INTERACTION_FEATURES if c not in feat.DOUBLE_FEATURES]


@query("feat_interaction", tidy_sql(
    O.with_views(O.interaction_features(SNAPSHOT)),
    dbl=["avg_session_duration_30d", "login_trend_30d_vs_60d", "mobile_usage_ratio_30d"], ints=_INT_INTS))
def q_feat_interaction(spark, sf):
    t = cleaned(spark, sf).interactions
    return tidy(feat.interaction_features(feat.historical(t, SNAPSHOT), SNAPSHOT))


@query("weekly_snapshot", tidy_sql(O.with_views(O.snapshot(SNAPSHOT)), money=MONEY, dbl=FEATURE_DBLS,
                                   ints=FEATURE_INTS, dates=DATES))
def q_weekly_snapshot(spark, sf):
    return tidy(snapshot_df(spark, sf), money=MONEY)


def _null_report_sql(src: str) -> str:
    cols = ["age", "state", "has_credit_card", "has_loan", "has_checking", "has_savings", "join_date",
            "gender"] + O.NUMERIC_FILL[1:]
    structs = ", ".join(f"{{'feature_name': '{c}', 'null_count': count(*) FILTER (WHERE {c} IS NULL)}}"
                        for c in cols)
    body = (f"SELECT total_rows, s.feature_name, s.null_count, "
            f"CASE WHEN total_rows > 0 THEN s.null_count / total_rows ELSE 0 END AS null_ratio FROM "
            f"(SELECT count(*) AS total_rows, unnest([{structs}]) AS s FROM ({src}))")
    status = ("SELECT *, CASE WHEN null_ratio > 0.5 THEN 'error' WHEN null_ratio > 0.1 THEN 'warn' "
              f"ELSE 'ok' END AS status FROM ({body})")
    return status


@query("feature_null_report", tidy_sql(O.with_views(_null_report_sql(O.snapshot(SNAPSHOT))),
                                       dbl=["null_ratio"], ints=["total_rows", "null_count"]))
def q_feature_null_report(spark, sf):
    return tidy(qual.null_report(snapshot_df(spark, sf)))


@query("feature_null_report_observed", tidy_sql(O.with_views(_null_report_sql(O.snapshot(SNAPSHOT))),
                                                dbl=["null_ratio"], ints=["total_rows", "null_count"]))
def q_feature_null_report_observed(spark, sf):
    """D9, I4 as metrics of the pass that writes the snapshot."""
    from retention.session import scratch_path
    return tidy(qual.write_with_null_report(snapshot_df(spark, sf), scratch_path(spark, "snapshot"))[1])


# ---------------------------------------------------------------- labels

@query("qualifying_activity", O.with_views(O.qualifying_activity(SNAPSHOT)))
def q_qualifying_activity(spark, sf):
    t = cleaned(spark, sf)
    return lab.qualifying_activity(t.transactions, t.interactions, SNAPSHOT)


def labels_df(spark, sf, s: str = SNAPSHOT) -> DataFrame:
    t = cleaned(spark, sf)
    return lab.churn_labels(t.customers, t.transactions, t.interactions, s)


@query("churn_labels", tidy_sql(O.with_views(O.churn_labels(SNAPSHOT)), ints=["churn_label"],
                                dates=["churned_date", "snapshot_date"]))
def q_churn_labels(spark, sf):
    return tidy(labels_df(spark, sf))


@query("churn_rate", tidy_sql(O.with_views(
    "SELECT *, CASE WHEN churn_rate >= 0.02 AND churn_rate <= 0.15 THEN 'ok' ELSE 'warn' END AS status FROM "
    "(SELECT total_customers, churned_customers, CASE WHEN total_customers > 0 THEN churned_customers / "
    "total_customers ELSE 0 END AS churn_rate FROM (SELECT count(*) AS total_customers, "
    f"count(*) FILTER (WHERE churn_label = 1) AS churned_customers FROM ({O.churn_labels(SNAPSHOT)})))"),
    dbl=["churn_rate"], ints=["total_customers", "churned_customers"]))
def q_churn_rate(spark, sf):
    return tidy(lab.churn_rate(labels_df(spark, sf)))


# ---------------------------------------------------------------- many snapshots (D4 x n, L2)

# The four weekly snapshots of the training range.
WEEKLY = ["2024-01-01", "2024-01-08", "2024-01-15", "2024-01-22"]


def multi_features_df(spark, sf, dates=WEEKLY) -> DataFrame:
    from retention.operators.multisnap import multi_snapshot_features
    t = cleaned(spark, sf)
    return multi_snapshot_features(spark, t.customers, t.transactions, t.interactions, dates)


def multi_labels_df(spark, sf, dates=WEEKLY) -> DataFrame:
    from retention.operators.multisnap import labels_for_dates
    t = cleaned(spark, sf)
    return labels_for_dates(spark, t.customers, t.transactions, t.interactions, dates)


def _union_all(parts: list[str]) -> str:
    return " UNION ALL ".join(f"SELECT * FROM ({q})" for q in parts)


def _day_states_sql() -> str:
    from retention.operators.daystate import AT_MIDNIGHT, STATES
    table = {"t": "transactions_clean", "i": "interactions_clean"}

    def columns(fact: str) -> str:
        out = []
        for s in STATES:
            for name, more in ((s.name, ""), (s.name + AT_MIDNIGHT, " AND timestamp = date_trunc('day', timestamp)")):
                if s.fact != fact:
                    out.append(f"{'0' if s.how == 'count' else 'NULL'} AS {name}")
                    continue
                test = "TRUE" + (f" AND {s.where[0]} = '{s.where[1]}'" if s.where else "") + (f" AND {s.of} > 0" if s.positive else "") + more
                inner = "*" if s.how == "count" and s.of is None else s.of
                out.append(f"{s.how}({inner}) FILTER (WHERE {test}) AS {name}")
        return ", ".join(out)

    both = " UNION ALL ".join(f"SELECT customer_id, CAST(timestamp AS DATE) AS day, {columns(f)} FROM {t} GROUP BY 1, 2" for f, t in table.items())
    merged = ", ".join(f"{'max' if s.how == 'max' else 'sum'}({n}) AS {n}" for s in STATES for n in (s.name, s.name + AT_MIDNIGHT))
    return O.with_views(f"SELECT customer_id, date_diff('day', DATE '1970-01-01', day) AS day, {merged} FROM ({both}) GROUP BY 1, 2")


def _day_states_types() -> dict:
    from retention.operators.daystate import AT_MIDNIGHT, STATES
    names = [(s, n) for s in STATES for n in (s.name, s.name + AT_MIDNIGHT)]
    return {"dbl": [n for s, n in names if s.how == "sum" and s.of == "amount"],
            "ints": ["day"] + [n for s, n in names if not (s.how == "sum" and s.of == "amount")]}


@query("customer_day_states", tidy_sql(_day_states_sql(), **_day_states_types()))
def q_customer_day_states(spark, sf):
    """The mergeable pre-aggregate that the features of any window are summed from."""
    from retention.operators.daystate import day_states
    t = cleaned(spark, sf)
    return tidy(day_states(t.transactions, t.interactions))


@query("multi_snapshot_features", tidy_sql(O.with_views(_union_all([O.snapshot(s) for s in WEEKLY])),
                                           money=MONEY, dbl=FEATURE_DBLS, ints=FEATURE_INTS, dates=DATES))
def q_multi_snapshot_features(spark, sf):
    return tidy(multi_features_df(spark, sf))


def _matured(dates, as_of, p=DEFAULT):
    from retention.functions.timewin import to_day
    return [s for s in dates if (to_day(as_of) - to_day(s)).days >= p.churn_horizon_days]


@query("backfill_labels", tidy_sql(O.with_views(_union_all([O.churn_labels(s) for s in _matured(WEEKLY, AS_OF)])),
                                   ints=["churn_label"], dates=["churned_date", "snapshot_date"]))
def q_backfill_labels(spark, sf):
    from retention.operators.multisnap import backfill_labels
    t = cleaned(spark, sf)
    hist = multi_features_df(spark, sf)
    return tidy(backfill_labels(hist, t.customers, t.transactions, t.interactions, AS_OF))


@query("backfill_none", tidy_sql(O.with_views(f"SELECT * FROM ({O.churn_labels(WEEKLY[0])}) WHERE FALSE"),
                                 ints=["churn_label"], dates=["churned_date", "snapshot_date"]))
def q_backfill_none(spark, sf):
    """No snapshot has matured, so no rows, with the columns of labels."""
    from retention.operators.multisnap import backfill_labels
    t = cleaned(spark, sf)
    return tidy(backfill_labels(multi_features_df(spark, sf), t.customers, t.transactions, t.interactions, WEEKLY[0]))


# ---------------------------------------------------------------- sources and store

@query("ingest_dated", tidy_sql(O.with_views("SELECT * FROM transactions"), money=["amount"], dates=["timestamp"]))
def q_ingest_dated(spark, sf):
    from retention.session import scratch_path
    from retention.sources.raw import ingest, write_dated
    root = scratch_path(spark, "raw")
    write_dated(raw(spark, sf).as_dict(), root, SNAPSHOT)
    return tidy(ingest(spark, root, SNAPSHOT)["transactions"], money=["amount"])


@query("ingest_dated_customers", tidy_sql(O.with_views("SELECT * FROM customers"), ints=["age"], dates=["join_date"]))
def q_ingest_dated_customers(spark, sf):
    """A1: the dated customers table, written and read back."""
    from retention.session import scratch_path
    from retention.sources.raw import ingest, write_dated
    root = scratch_path(spark, "raw")
    write_dated(raw(spark, sf).as_dict(), root, SNAPSHOT)
    return tidy(ingest(spark, root, SNAPSHOT)["customers"])


@query("ingest_dated_interactions", tidy_sql(O.with_views("SELECT * FROM interactions"), ints=["session_duration"],
                                             dates=["timestamp"]))
def q_ingest_dated_interactions(spark, sf):
    """A3: the dated interactions table, written and read back."""
    from retention.session import scratch_path
    from retention.sources.raw import ingest, write_dated
    root = scratch_path(spark, "raw")
    write_dated(raw(spark, sf).as_dict(), root, SNAPSHOT)
    return tidy(ingest(spark, root, SNAPSHOT)["interactions"])


def _schema_scan_sql() -> str:
    from retention.sources.schemas import EXPECTED
    rows = []
    for t, declared in EXPECTED.items():
        for f in declared.fields:
            rows.append(f"SELECT '{t}' AS table_name, '{f.name}' AS column_name, count(*) AS n_rows, "
                        f"{'CAST(0 AS BIGINT)' if f.nullable else f'count(*) - count({f.name})'} AS n_missing FROM {t}")
    return O.with_views(" UNION ALL ".join(rows))


@query("schema_scan", tidy_sql(_schema_scan_sql(), ints=["n_rows", "n_missing"]))
def q_schema_scan(spark, sf):
    """A5, A6 over the rows: per declared column the rows, and those null where the schema forbids it."""
    from retention.operators.quality import schema_scan
    return tidy(schema_scan(raw(spark, sf).as_dict()))


@query("export_millis", tidy_sql(O.with_views("SELECT * EXCLUDE (product) REPLACE (date_trunc('millisecond', timestamp) AS timestamp) "
                                              "FROM transactions"), money=["amount"], dates=["timestamp"]))
def q_export_millis(spark, sf):
    """Exported without a column, at millisecond precision, and read back."""
    from retention.session import scratch_path
    from retention.sources.raw import export_parquet
    path = scratch_path(spark, "export")
    export_parquet(raw(spark, sf).transactions, path, drop=("product",), millis="timestamp")
    return tidy(spark.read.parquet(path), money=["amount"])


@query("export_millis_interactions", tidy_sql(O.with_views("SELECT * REPLACE (date_trunc('millisecond', timestamp) AS timestamp) FROM interactions"),
                                              ints=["session_duration"], dates=["timestamp"]))
def q_export_millis_interactions(spark, sf):
    """B24 on timestamps with microseconds."""
    from retention.session import scratch_path
    from retention.sources.raw import export_parquet
    path = scratch_path(spark, "export")
    export_parquet(raw(spark, sf).interactions, path, millis="timestamp")
    return tidy(spark.read.parquet(path))


def _store(spark):
    from retention.session import scratch_path
    from retention.sources.store import FeatureStore
    return FeatureStore(spark, scratch_path(spark, "store"))


@query("store_roundtrip_features", tidy_sql(
    O.with_views(_union_all([O.snapshot(s) for s in ("2024-01-08", "2024-01-15")])),
    money=MONEY, dbl=FEATURE_DBLS, ints=FEATURE_INTS, dates=DATES))
def q_store_roundtrip_features(spark, sf):
    st = _store(spark)
    st.store_features(multi_features_df(spark, sf))
    return tidy(st.load_features_range("2024-01-08", "2024-01-15"), money=MONEY)


@query("store_one_features", tidy_sql(O.with_views(O.snapshot(SNAPSHOT)), money=MONEY, dbl=FEATURE_DBLS, ints=FEATURE_INTS,
                                      dates=DATES))
def q_store_one_features(spark, sf):
    """One date of the feature store."""
    st = _store(spark)
    st.store_features(multi_features_df(spark, sf))
    return tidy(st.load_features(SNAPSHOT), money=MONEY)


@query("store_one_labels", tidy_sql(O.with_views(O.churn_labels(SNAPSHOT)), ints=["churn_label"],
                                    dates=["churned_date", "snapshot_date"]))
def q_store_one_labels(spark, sf):
    """A10: one date of the label store."""
    st = _store(spark)
    st.store_labels(multi_labels_df(spark, sf))
    return tidy(st.load_labels(SNAPSHOT))


@query("store_range_labels", tidy_sql(
    O.with_views(_union_all([O.churn_labels(s) for s in ("2024-01-01", "2024-01-08", "2024-01-15")])),
    ints=["churn_label"], dates=["churned_date", "snapshot_date"]))
def q_store_range_labels(spark, sf):
    st = _store(spark)
    st.store_labels(multi_labels_df(spark, sf))
    return tidy(st.load_labels_range("2024-01-01", "2024-01-15"))


@query("csv_scan", tidy_sql("SELECT * FROM part", dbl=["p_retailprice"], ints=["p_partkey", "p_size"]))
def q_csv_scan(spark, sf):
    from retention.session import scratch_path
    from retention.sources.raw import read_csv, write_csv_gz
    part = fx.read_table(spark, sf, "part")
    path = scratch_path(spark, "csv")
    write_csv_gz(part, path)
    return tidy(read_csv(spark, path, part.schema))


@query("csv_scan_inferred", tidy_sql("SELECT * FROM orders", dbl=["o_totalprice"], ints=["o_orderkey", "o_custkey"], dates=["o_orderdate"]))
def q_csv_scan_inferred(spark, sf):
    """Types found by one aggregate over gzip files, then a typed scan."""
    from retention.session import scratch_path
    from retention.sources.raw import read_csv_inferred, write_csv_gz
    path = scratch_path(spark, "csv")
    write_csv_gz(fx.read_table(spark, sf, "orders"), path)
    return tidy(read_csv_inferred(spark, path))


# ---------------------------------------------------------------- training set and split

SPLIT_DATE = "2024-01-08"
SPLIT_SQL = f"substring(md5(customer_id), 1, {HEX_DIGITS}) < '{hex_threshold(DEFAULT.train_ratio)}'"


def training_df(spark, sf) -> DataFrame:
    from retention.operators.split import training_set
    return training_set(multi_features_df(spark, sf), multi_labels_df(spark, sf))


def _base_views() -> dict[str, str]:
    from retention.operators.scoring import LINEAR_INTERCEPT, LINEAR_WEIGHTS
    z = f"CAST({LINEAR_INTERCEPT} AS DOUBLE)" + "".join(
        f" + CAST({w} AS DOUBLE) * CAST({n} AS DOUBLE)" for n, w in LINEAR_WEIGHTS)
    prob = f"(0.5 + 0.5 * ({z}) / (1.0 + abs({z})))"
    return {
        "features4": _union_all([O.snapshot(s) for s in WEEKLY]),
        "labels4": _union_all([O.churn_labels(s) for s in WEEKLY]),
        "training": "SELECT f.*, l.churn_label, l.churned_date FROM features4 f "
                    "JOIN labels4 l USING (customer_id, snapshot_date)",
        "scored": f"SELECT customer_id, snapshot_date, churn_label, {prob} AS churn_probability, "
                  f"CAST({prob} > 0.5 AS INTEGER) AS churn_prediction, DATE '{AS_OF}' AS prediction_date "
                  "FROM training",
        "scored1": f"SELECT customer_id, snapshot_date, {prob} AS churn_probability, "
                   f"CAST({prob} > 0.5 AS INTEGER) AS churn_prediction, DATE '{AS_OF}' AS prediction_date "
                   f"FROM ({O.snapshot(SNAPSHOT)})",
        "curve0": "SELECT churn_probability AS score, CAST(sum(churn_label) AS BIGINT) AS pos, "
                  "CAST(sum(1 - churn_label) AS BIGINT) AS neg FROM scored GROUP BY 1",
        "curve": "SELECT score, pos, neg, "
                 "CAST(coalesce(sum(pos) OVER (ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS pos_above, "
                 "CAST(coalesce(sum(neg) OVER (ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS neg_above, "
                 "CAST(sum(pos) OVER () AS BIGINT) AS P, CAST(sum(neg) OVER () AS BIGINT) AS N FROM curve0",
    }


def V(body: str) -> str:
    return O.with_views(body, _base_views())


LABEL_INTS = FEATURE_INTS + ["churn_label"]
LABEL_DATES = DATES + ["churned_date"]


@query("training_set", tidy_sql(V("SELECT * FROM training"), money=MONEY, dbl=FEATURE_DBLS,
                                ints=LABEL_INTS, dates=LABEL_DATES))
def q_training_set(spark, sf):
    return tidy(training_df(spark, sf), money=MONEY)


@query("split_train", tidy_sql(V(f"SELECT * FROM training WHERE {SPLIT_SQL} AND snapshot_date <= DATE '{SPLIT_DATE}'"),
                               money=MONEY, dbl=FEATURE_DBLS, ints=LABEL_INTS, dates=LABEL_DATES))
def q_split_train(spark, sf):
    from retention.operators.split import split
    return tidy(split(training_df(spark, sf), SPLIT_DATE)[0], money=MONEY)


@query("split_val", tidy_sql(V(f"SELECT * FROM training WHERE NOT ({SPLIT_SQL}) AND snapshot_date > DATE '{SPLIT_DATE}'"),
                             money=MONEY, dbl=FEATURE_DBLS, ints=LABEL_INTS, dates=LABEL_DATES))
def q_split_val(spark, sf):
    from retention.operators.split import split
    return tidy(split(training_df(spark, sf), SPLIT_DATE)[1], money=MONEY)


_SIDES_SQL = f"""WITH tr AS (SELECT * FROM training WHERE {SPLIT_SQL} AND snapshot_date <= DATE '{SPLIT_DATE}'),
va AS (SELECT * FROM training WHERE NOT ({SPLIT_SQL}) AND snapshot_date > DATE '{SPLIT_DATE}')
"""
_LEAK_SQL = f"""SELECT * FROM ({_SIDES_SQL}SELECT *, CASE WHEN overlap_customers > 0 OR max_train_date > min_val_date THEN 'error' ELSE 'ok' END AS status
FROM (SELECT
  (SELECT count(DISTINCT customer_id) FROM tr) AS train_customers,
  (SELECT count(DISTINCT customer_id) FROM va) AS val_customers,
  (SELECT count(*) FROM (SELECT customer_id FROM tr INTERSECT SELECT customer_id FROM va)) AS overlap_customers,
  (SELECT count(*) FROM tr) AS train_samples,
  (SELECT count(*) FROM va) AS val_samples,
  (SELECT max(snapshot_date) FROM tr) AS max_train_date,
  (SELECT min(snapshot_date) FROM va) AS min_val_date))"""


@query("split_leak_check", tidy_sql(V(_LEAK_SQL), ints=["train_customers", "val_customers", "overlap_customers",
                                                       "train_samples", "val_samples"],
                                    dates=["max_train_date", "min_val_date"]))
def q_split_leak_check(spark, sf):
    from retention.operators.split import split, split_report
    return tidy(split_report(*split(training_df(spark, sf), SPLIT_DATE)))


@query("split_val_customers", V(f"SELECT customer_id FROM training EXCEPT SELECT customer_id FROM training WHERE {SPLIT_SQL}"))
def q_split_val_customers(spark, sf):
    """The validation customers, by EXCEPT over the distinct customers."""
    from retention.operators.split import customer_sets
    return customer_sets(training_df(spark, sf).select("customer_id").distinct())[1]


@query("split_date_customers", V(f"SELECT customer_id FROM training WHERE snapshot_date <= DATE '{SPLIT_DATE}' "
                                 f"INTERSECT SELECT customer_id FROM training WHERE snapshot_date > DATE '{SPLIT_DATE}'"))
def q_split_date_customers(spark, sf):
    """E7's intersect over a split by date alone, where customers do stand on both sides."""
    from retention.operators.split import customer_overlap
    t = training_df(spark, sf).select("customer_id", "snapshot_date")
    early = F.col("snapshot_date") <= F.lit(SPLIT_DATE).cast("date")
    return customer_overlap(t.filter(early).select("customer_id"), t.filter(~early).select("customer_id"))


SAMPLE_N = DEFAULT.shap_sample_size
_SAMPLE_SQL = ("SELECT * FROM features4 ORDER BY md5(customer_id || '|' || CAST(snapshot_date AS VARCHAR)), "
               f"customer_id, snapshot_date LIMIT {SAMPLE_N}")


def sample_df(spark, sf) -> DataFrame:
    """G3 over the features: the rows of the smallest hashes."""
    from retention.operators.split import sample_for_explanation
    return sample_for_explanation(multi_features_df(spark, sf), SAMPLE_N)


@query("shap_sample", tidy_sql(V(_SAMPLE_SQL), money=MONEY, dbl=FEATURE_DBLS, ints=FEATURE_INTS, dates=DATES))
def q_shap_sample(spark, sf):
    return tidy(sample_df(spark, sf), money=MONEY)


# ---------------------------------------------------------------- scoring and metrics

def scored_df(spark, sf) -> DataFrame:
    from retention.operators.scoring import linear_score
    return linear_score(training_df(spark, sf), AS_OF, keep=("churn_label",))


def curve_df(spark, sf) -> DataFrame:
    from retention.operators.ranking import score_curve
    return score_curve(scored_df(spark, sf))


@query("score_linear", tidy_sql(V("SELECT * FROM scored"), dbl=["churn_probability"],
                                ints=["churn_label", "churn_prediction"], dates=["snapshot_date", "prediction_date"]))
def q_score_linear(spark, sf):
    return tidy(scored_df(spark, sf))


@query("top_risk", tidy_sql(V("SELECT *, row_number() OVER (ORDER BY churn_probability DESC, customer_id, snapshot_date) "
                              "AS churn_rank FROM scored1 ORDER BY churn_rank LIMIT 1000"),
                            dbl=["churn_probability"], ints=["churn_prediction", "churn_rank"],
                            dates=["snapshot_date", "prediction_date"]))
def q_top_risk(spark, sf):
    from retention.operators.scoring import linear_score, top_risk
    return tidy(top_risk(linear_score(snapshot_df(spark, sf), AS_OF), 1000))


_AUC_SQL = ("SELECT CASE WHEN max(P) * max(N) > 0 THEN sum(CAST(pos AS DOUBLE) * (CAST(N - neg_above - neg AS DOUBLE) "
            "+ CAST(neg AS DOUBLE) * 0.5)) / (CAST(max(P) AS DOUBLE) * CAST(max(N) AS DOUBLE)) END AS auc FROM curve")


@query("eval_auc", tidy_sql(V(_AUC_SQL), dbl=["auc"]))
def q_eval_auc(spark, sf):
    from retention.operators.ranking import auc
    return tidy(auc(curve_df(spark, sf)))


_PRF_SQL = """SELECT n_rows, tp, fp, fn,
  CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0 END AS precision,
  CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0 END AS recall,
  CASE WHEN 2 * tp + fp + fn > 0 THEN 2 * tp / (2 * tp + fp + fn) ELSE 0 END AS f1
FROM (SELECT count(*) FILTER (WHERE churn_label = 1 AND churn_prediction = 1) AS tp,
  count(*) FILTER (WHERE churn_label <> 1 AND churn_prediction = 1) AS fp,
  count(*) FILTER (WHERE churn_label = 1 AND churn_prediction <> 1) AS fn, count(*) AS n_rows FROM scored)"""


@query("eval_prf", tidy_sql(V(_PRF_SQL), dbl=["precision", "recall", "f1"], ints=["n_rows", "tp", "fp", "fn"]))
def q_eval_prf(spark, sf):
    from retention.operators.ranking import prf
    return tidy(prf(scored_df(spark, sf)))


_PAR_SQL = f"""SELECT precision AS precision_at_target_recall, recall AS recall_at_pick, threshold FROM (
  SELECT 0 AS _end, score AS threshold,
    CASE WHEN P > 0 THEN (pos_above + pos) / P ELSE 1.0 END AS recall,
    CASE WHEN pos_above + pos + neg_above + neg > 0 THEN (pos_above + pos) / (pos_above + pos + neg_above + neg)
         ELSE 0 END AS precision FROM curve
  UNION ALL SELECT 1, NULL, 0.0, 1.0)
ORDER BY abs(recall - CAST({DEFAULT.target_recall} AS DOUBLE)), _end, threshold LIMIT 1"""


@query("eval_precision_at_recall", tidy_sql(V(_PAR_SQL), dbl=["precision_at_target_recall", "recall_at_pick",
                                                              "threshold"]))
def q_eval_precision_at_recall(spark, sf):
    from retention.operators.ranking import precision_at_recall
    return tidy(precision_at_recall(curve_df(spark, sf), DEFAULT.target_recall))


_METRICS_SQL = (f"SELECT p.n_rows, (SELECT count(*) FROM scored WHERE churn_probability IS NULL) AS n_unscored, a.auc, p.precision, p.recall, p.f1, r.precision_at_target_recall "
                f"FROM ({_PRF_SQL}) p, ({_AUC_SQL}) a, ({_PAR_SQL}) r")


@query("eval_metrics", tidy_sql(V(_METRICS_SQL), dbl=["auc", "precision", "recall", "f1",
                                                      "precision_at_target_recall"], ints=["n_rows", "n_unscored"]))
def q_eval_metrics(spark, sf):
    return tidy(metrics_df(spark, sf))


def metrics_df(spark, sf) -> DataFrame:
    from retention.operators.ranking import metrics
    return metrics(scored_df(spark, sf), DEFAULT.target_recall)


_GATE_SQL = (f"SELECT metric, value, minimum, CASE WHEN value < minimum THEN 'warn' ELSE 'ok' END AS status FROM ("
             f"SELECT 'auc' AS metric, auc AS value, CAST({DEFAULT.min_auc_threshold} AS DOUBLE) AS minimum FROM ({_METRICS_SQL}) "
             f"UNION ALL SELECT 'precision_at_target_recall', precision_at_target_recall, "
             f"CAST({DEFAULT.min_precision_threshold} AS DOUBLE) FROM ({_METRICS_SQL}))")


@query("threshold_gate", tidy_sql(V(_GATE_SQL), dbl=["value", "minimum"]))
def q_threshold_gate(spark, sf):
    from retention.operators.ranking import threshold_gate
    return tidy(threshold_gate(metrics_df(spark, sf), DEFAULT.min_auc_threshold, DEFAULT.min_precision_threshold))


_ROC_SQL = """SELECT score AS threshold, pos_above + pos AS tps, neg_above + neg AS fps,
  CASE WHEN P > 0 THEN (pos_above + pos) / P ELSE 0 END AS tpr,
  CASE WHEN N > 0 THEN (neg_above + neg) / N ELSE 0 END AS fpr,
  CASE WHEN pos_above + pos + neg_above + neg > 0 THEN (pos_above + pos) / (pos_above + pos + neg_above + neg) ELSE 0 END
    AS precision FROM curve"""


@query("roc_curve", tidy_sql(V(_ROC_SQL), dbl=["threshold", "tpr", "fpr", "precision"], ints=["tps", "fps"]))
def q_roc_curve(spark, sf):
    from retention.operators.ranking import roc_curve
    return tidy(roc_curve(curve_df(spark, sf)))


_LIFT_SQL = """SELECT decile, customers, churners, churners / customers AS churn_rate,
  CASE WHEN P > 0 THEN (churners / customers) / (P / (P + N)) ELSE 0 END AS lift
FROM (SELECT CAST(floor(10 * (pos_above + neg_above) / (P + N)) AS INTEGER) + 1 AS decile,
  sum(pos + neg) AS customers, sum(pos) AS churners, max(P) AS P, max(N) AS N
  FROM curve WHERE P + N > 0 GROUP BY 1)"""


@query("lift_deciles", tidy_sql(V(_LIFT_SQL), dbl=["churn_rate", "lift"], ints=["decile", "customers", "churners"]))
def q_lift_deciles(spark, sf):
    from retention.operators.ranking import lift_deciles
    return tidy(lift_deciles(curve_df(spark, sf)))


# ---------------------------------------------------------------- drift and attributions

DRIFT_REFERENCE = "2024-01-01"


def _stats_sql(src: str, cols: list[str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS feature_name, avg(CAST({c} AS DOUBLE)) AS mean, stddev_samp(CAST({c} AS DOUBLE)) AS std "
        f"FROM {src}" for c in cols)


def _drift_sql() -> str:
    cols = feat.MODEL_FEATURES
    extra = {"cur": O.snapshot(SNAPSHOT), "ref": O.snapshot(DRIFT_REFERENCE)}
    body = (f"SELECT c.feature_name, c.mean AS current_mean, c.std AS current_std, r.mean AS reference_mean, "
            f"r.std AS reference_std, CASE WHEN r.std > 0 THEN abs(c.mean - r.mean) / r.std ELSE 0 END AS drift_score "
            f"FROM ({_stats_sql('cur', cols)}) c JOIN ({_stats_sql('ref', cols)}) r USING (feature_name)")
    return O.with_views(body, extra)


@query("drift", tidy_sql(_drift_sql(), dbl=["current_mean", "current_std", "reference_mean", "reference_std",
                                           "drift_score"]))
def q_drift(spark, sf):
    from retention.operators.drift import drift_between
    both = multi_features_df(spark, sf, [DRIFT_REFERENCE, SNAPSHOT])
    return tidy(drift_between(both, SNAPSHOT, DRIFT_REFERENCE, feat.MODEL_FEATURES))


def _shap_sql() -> str:
    from retention.operators.scoring import LINEAR_INTERCEPT, LINEAR_WEIGHTS
    means = ", ".join(f"avg(CAST({n} AS DOUBLE)) OVER () AS m_{n}" for n, _ in LINEAR_WEIGHTS)
    ev = f"CAST({LINEAR_INTERCEPT} AS DOUBLE)" + "".join(
        f" + CAST({w} AS DOUBLE) * m_{n}" for n, w in LINEAR_WEIGHTS)
    cols = ", ".join(f"CAST({w} AS DOUBLE) * (CAST({n} AS DOUBLE) - m_{n}) AS shap_{n}" for n, w in LINEAR_WEIGHTS)
    return (f"SELECT customer_id, snapshot_date, {ev} AS expected_value, {cols} "
            f"FROM (SELECT *, {means} FROM features4)")


def shap_df(spark, sf) -> DataFrame:
    """Explanations of all rows; the background means come from one aggregate over them."""
    from retention.operators.explain import background_stats, linear_explanations
    from retention.operators.scoring import LINEAR_INTERCEPT, LINEAR_WEIGHTS
    from retention.session import materialize
    feats = materialize(multi_features_df(spark, sf))
    _, means = background_stats(feats, [n for n, _ in LINEAR_WEIGHTS])
    return linear_explanations(feats, None, LINEAR_WEIGHTS, LINEAR_INTERCEPT, means=means)


def _shap_cols():
    from retention.operators.scoring import LINEAR_WEIGHTS
    return ["expected_value"] + [f"shap_{n}" for n, _ in LINEAR_WEIGHTS]


@query("shap_linear", tidy_sql(V(_shap_sql()), dbl=_shap_cols(), dates=["snapshot_date"]))
def q_shap_linear(spark, sf):
    return tidy(shap_df(spark, sf))


def _importance_sql() -> str:
    from retention.operators.scoring import LINEAR_WEIGHTS
    parts = " UNION ALL ".join(f"SELECT '{n}' AS feature_name, avg(abs(shap_{n})) AS importance FROM e"
                               for n, _ in LINEAR_WEIGHTS)
    return (f"WITH e AS ({_shap_sql()}) SELECT *, row_number() OVER (ORDER BY importance DESC, feature_name) AS rank "
            f"FROM ({parts})")


@query("global_importance", tidy_sql(V(f"SELECT * FROM ({_importance_sql()})"), dbl=["importance"], ints=["rank"]))
def q_global_importance(spark, sf):
    from retention.operators.explain import global_importance
    return tidy(global_importance(shap_df(spark, sf)))


# ---------------------------------------------------------------- profile

# The profile's end date and trend year.
PROFILE_END = "2024-01-31"
TREND_YEAR = 2023
ACT_SQL = ("SELECT customer_id, max(timestamp) AS last_activity FROM (SELECT customer_id, timestamp FROM transactions "
           "UNION ALL SELECT customer_id, timestamp FROM interactions) GROUP BY customer_id")


def _t(day_offset: int) -> str:
    from retention.functions.timewin import shift
    return f"TIMESTAMP '{shift(PROFILE_END, day_offset)} 00:00:00'"


@query("value_share", tidy_sql(O.with_views(
    "SELECT 'transactions' AS table_name, product AS value, count(*) AS rows, count(*) / sum(count(*)) OVER () AS share "
    "FROM transactions GROUP BY product UNION ALL SELECT 'interactions', interaction_type, count(*), "
    "count(*) / sum(count(*)) OVER () FROM interactions GROUP BY interaction_type"), dbl=["share"], ints=["rows"]))
def q_value_share(spark, sf):
    from retention.operators.profile import value_share
    t = raw(spark, sf)
    return tidy(value_share(t.transactions, "product", "transactions")
                .unionByName(value_share(t.interactions, "interaction_type", "interactions")))


@query("monthly_volume", tidy_sql(O.with_views(
    "SELECT 'transactions' AS table_name, count(*) AS months, avg(rows) AS monthly_mean, stddev_samp(rows) AS monthly_std "
    "FROM (SELECT date_trunc('month', timestamp) AS m, count(*) AS rows FROM transactions GROUP BY 1)"),
    dbl=["monthly_mean", "monthly_std"], ints=["months"]))
def q_monthly_volume(spark, sf):
    from retention.operators.profile import monthly_volume
    return tidy(monthly_volume(raw(spark, sf).transactions, "transactions"))


def _inactive_sql() -> str:
    from retention.operators.profile import INACTIVITY_CUTOFFS
    parts = " UNION ALL ".join(
        f"SELECT {c} AS cutoff_days, count(*) FILTER (WHERE last_activity > {_t(-c)}) AS active_ids FROM act"
        for c in INACTIVITY_CUTOFFS)
    return O.with_views(
        "SELECT cutoff_days, active_ids, n AS customers, n - active_ids AS inactive_customers, "
        "CASE WHEN n > 0 THEN (n - active_ids) / n * 100 ELSE 0 END AS inactive_pct "
        f"FROM ({parts}) a, (SELECT count(*) AS n FROM customers) c", {"act": ACT_SQL})


@query("inactive_by_cutoff", tidy_sql(_inactive_sql(), dbl=["inactive_pct"],
                                      ints=["cutoff_days", "active_ids", "customers", "inactive_customers"]))
def q_inactive_by_cutoff(spark, sf):
    from retention.operators.profile import inactive_by_cutoff
    t = raw(spark, sf)
    return tidy(inactive_by_cutoff(t.customers, t.transactions, t.interactions, PROFILE_END))


@query("activity_trend", tidy_sql(O.with_views(
    f"SELECT {TREND_YEAR} AS year, sum(rows) AS activity_rows, regr_slope(CAST(rows AS DOUBLE), CAST(month AS DOUBLE)) AS trend "
    "FROM (SELECT m.month, coalesce(p.rows, 0) AS rows FROM (SELECT range AS month FROM range(1, 13)) m LEFT JOIN "
    "(SELECT month(timestamp) AS month, count(*) AS rows FROM (SELECT timestamp FROM transactions UNION ALL "
    f"SELECT timestamp FROM interactions) WHERE timestamp >= TIMESTAMP '{TREND_YEAR}-01-01 00:00:00' AND "
    f"timestamp < TIMESTAMP '{TREND_YEAR + 1}-01-01 00:00:00' GROUP BY 1) p USING (month))"),
    dbl=["trend"], ints=["year", "activity_rows"]))
def q_activity_trend(spark, sf):
    from retention.operators.profile import activity_trend
    t = raw(spark, sf)
    return tidy(activity_trend(t.transactions, t.interactions, TREND_YEAR))


@query("lifecycle_distribution", tidy_sql(O.with_views(
    "SELECT state, customers, CASE WHEN n > 0 THEN customers / n * 100 ELSE 0 END AS pct FROM ("
    "SELECT state, count(*) AS customers FROM (SELECT CASE WHEN a.last_activity > " + _t(-30) + " THEN 'stable' "
    "WHEN a.last_activity > " + _t(-60) + " THEN 'at_risk' WHEN c.customer_id IS NOT NULL THEN 'churned' END AS state "
    "FROM act a FULL JOIN (SELECT DISTINCT customer_id FROM customers) c ON a.customer_id = c.customer_id) "
    "WHERE state IS NOT NULL GROUP BY state) g, (SELECT count(DISTINCT customer_id) AS n FROM customers) n",
    {"act": ACT_SQL}), dbl=["pct"], ints=["customers"]))
def q_lifecycle_distribution(spark, sf):
    from retention.operators.profile import lifecycle_distribution
    t = raw(spark, sf)
    return tidy(lifecycle_distribution(t.customers, t.transactions, t.interactions, PROFILE_END))


TXN_STATS_SQL = ("SELECT customer_id, count(amount) AS txn_count, sum(amount) AS txn_sum, avg(amount) AS txn_mean, "
                 "stddev_samp(amount) AS txn_std, min(timestamp) AS first_txn, max(timestamp) AS last_txn "
                 "FROM transactions GROUP BY customer_id")


@query("txn_stats", tidy_sql(O.with_views(TXN_STATS_SQL), dbl=["txn_sum", "txn_mean", "txn_std"], ints=["txn_count"],
                             dates=["first_txn", "last_txn"]))
def q_txn_stats(spark, sf):
    from retention.operators.profile import txn_stats
    return tidy(txn_stats(raw(spark, sf).transactions))


@query("interaction_stats", tidy_sql(O.with_views(
    "SELECT customer_id, count(interaction_type) AS interaction_count, min(timestamp) AS first_interaction, "
    "max(timestamp) AS last_interaction FROM interactions GROUP BY customer_id"),
    ints=["interaction_count"], dates=["first_interaction", "last_interaction"]))
def q_interaction_stats(spark, sf):
    from retention.operators.profile import interaction_stats
    return tidy(interaction_stats(raw(spark, sf).interactions))


@query("age_summary", tidy_sql(O.with_views(
    "SELECT count(age) AS age_count, avg(age) AS age_mean, stddev_samp(age) AS age_std, min(age) AS age_min, "
    "max(age) AS age_max FROM customers"), dbl=["age_mean", "age_std"], ints=["age_count", "age_min", "age_max"]))
def q_age_summary(spark, sf):
    from retention.operators.profile import age_summary
    return tidy(age_summary(raw(spark, sf).customers))


@query("penetration", tidy_sql(O.with_views(
    "SELECT avg(CAST(has_checking AS INTEGER)) AS checking, avg(CAST(has_savings AS INTEGER)) AS savings, "
    "avg(CAST(has_credit_card AS INTEGER)) AS credit_card, avg(CAST(has_loan AS INTEGER)) AS loan FROM customers"),
    dbl=["checking", "savings", "credit_card", "loan"]))
def q_penetration(spark, sf):
    from retention.operators.profile import penetration
    return tidy(penetration(raw(spark, sf).customers))


LAST_SQL = ("SELECT c.customer_id, t.last_txn, i.last_interaction, greatest(t.last_txn, i.last_interaction) AS last_activity "
            "FROM (SELECT customer_id FROM customers) c "
            "LEFT JOIN (SELECT customer_id, max(timestamp) AS last_txn FROM transactions GROUP BY 1) t USING (customer_id) "
            "LEFT JOIN (SELECT customer_id, max(timestamp) AS last_interaction FROM interactions GROUP BY 1) i USING (customer_id)")


def last_df(spark, sf) -> DataFrame:
    from retention.operators.profile import last_activity
    t = raw(spark, sf)
    return last_activity(t.customers, t.transactions, t.interactions)


@query("last_activity", tidy_sql(O.with_views(LAST_SQL), dates=["last_txn", "last_interaction", "last_activity"]))
def q_last_activity(spark, sf):
    return tidy(last_df(spark, sf))


def _recency_sql() -> str:
    from retention.operators.profile import RECENCY_THRESHOLDS as R
    days = (f"(date_diff('day', CAST(last_activity AS DATE), DATE '{PROFILE_END}') - CASE WHEN "
            "CAST(CAST(last_activity AS DATE) AS TIMESTAMP) < last_activity THEN 1 ELSE 0 END)")
    cnt = ", ".join(f"count(*) FILTER (WHERE days >= {t}) AS inactive_{t}d" for t in R)
    pct = ", ".join(f"CASE WHEN active_customers > 0 THEN inactive_{t}d / active_customers * 100 ELSE 0 END "
                    f"AS inactive_{t}d_pct" for t in R)
    return O.with_views(f"SELECT *, {pct} FROM (SELECT count(*) AS active_customers, avg(days) AS mean_days, {cnt} "
                        f"FROM (SELECT {days} AS days FROM ({LAST_SQL}) WHERE last_activity IS NOT NULL))")


@query("recency_distribution", tidy_sql(_recency_sql(), dbl=["mean_days", "inactive_30d_pct", "inactive_60d_pct",
                                                             "inactive_90d_pct"],
                                        ints=["active_customers", "inactive_30d", "inactive_60d", "inactive_90d"]))
def q_recency_distribution(spark, sf):
    from retention.operators.profile import recency_distribution
    return tidy(recency_distribution(last_df(spark, sf), PROFILE_END))


@query("profile_counts", tidy_sql(O.with_views(
    "SELECT *, CASE WHEN customers > 0 THEN transactions / customers ELSE 0 END AS txn_per_customer, "
    "CASE WHEN customers > 0 THEN interactions / customers ELSE 0 END AS interactions_per_customer FROM (SELECT "
    "(SELECT count(*) FROM customers) AS customers, (SELECT count(*) FROM transactions) AS transactions, "
    "(SELECT count(*) FROM interactions) AS interactions, (SELECT min(timestamp) FROM transactions) AS txn_first, "
    "(SELECT max(timestamp) FROM transactions) AS txn_last, (SELECT min(timestamp) FROM interactions) AS interaction_first, "
    "(SELECT max(timestamp) FROM interactions) AS interaction_last)"),
    dbl=["txn_per_customer", "interactions_per_customer"], ints=["customers", "transactions", "interactions"],
    dates=["txn_first", "txn_last", "interaction_first", "interaction_last"]))
def q_profile_counts(spark, sf):
    from retention.operators.profile import profile_counts
    t = raw(spark, sf)
    return tidy(profile_counts(t.customers, t.transactions, t.interactions))


# ---------------------------------------------------------------- customer 360

def _pivot_sql() -> str:
    from retention.operators.customer360 import EVENT_TYPES, OTHER_EVENTS
    cols = ", ".join(f"count(*) FILTER (WHERE event_type = '{e}') AS {e}" for e in EVENT_TYPES)
    listed = ", ".join(f"'{e}'" for e in EVENT_TYPES)
    cols += f", count(*) FILTER (WHERE event_type IS NULL OR event_type NOT IN ({listed})) AS {OTHER_EVENTS}"
    return f"SELECT CAST(user_id AS VARCHAR) AS customer_id, {cols} FROM events GROUP BY 1"


def pivot_df(spark, sf) -> DataFrame:
    from retention.operators.customer360 import event_pivot
    ev = fx.read_table(spark, sf, "events").select(F.col("user_id").cast("string").alias("customer_id"), "event_type")
    return event_pivot(ev)


def _event_ints():
    from retention.operators.customer360 import EVENT_TYPES, OTHER_EVENTS
    return [*EVENT_TYPES, OTHER_EVENTS]


@query("event_pivot", tidy_sql(_pivot_sql(), ints=_event_ints()))
def q_event_pivot(spark, sf):
    return tidy(pivot_df(spark, sf))


LIFE_SQL = ("SELECT customer_id, CAST(date_diff('day', CAST(last_activity AS DATE), DATE '" + PROFILE_END + "') AS INTEGER) "
            "AS recency_days, CASE WHEN date_diff('day', CAST(last_activity AS DATE), DATE '" + PROFILE_END + "') < 15 THEN 'active' "
            "WHEN date_diff('day', CAST(last_activity AS DATE), DATE '" + PROFILE_END + "') < 45 THEN 'dormant' "
            "WHEN date_diff('day', CAST(last_activity AS DATE), DATE '" + PROFILE_END + "') < 60 THEN 'at-risk' "
            f"ELSE 'lost' END AS lifecycle_state FROM ({LAST_SQL})")


def life_df(spark, sf) -> DataFrame:
    from retention.operators.customer360 import lifecycle
    return lifecycle(last_df(spark, sf), PROFILE_END)


@query("lifecycle_bucket", tidy_sql(O.with_views(LIFE_SQL), ints=["recency_days"]))
def q_lifecycle_bucket(spark, sf):
    return tidy(life_df(spark, sf))


@query("basket_join", tidy_sql(
    "SELECT o_orderkey AS order_id, o_custkey AS customer_key, o_orderdate AS order_date, p_partkey AS product_id, "
    "p_name AS product_name, p_type AS product_type, l_linenumber AS line_number, l_quantity AS quantity, "
    "l_extendedprice AS price, CASE l_linestatus WHEN 'F' THEN 'prior' WHEN 'O' THEN 'train' ELSE 'other' END AS eval_set "
    "FROM orders JOIN lineitem ON o_orderkey = l_orderkey JOIN part ON p_partkey = l_partkey",
    dbl=["quantity", "price"], ints=["order_id", "customer_key", "product_id", "line_number"], dates=["order_date"]))
def q_basket_join(spark, sf):
    from retention.operators.customer360 import basket_join
    r = lambda n: fx.read_table(spark, sf, n)
    return tidy(basket_join(r("orders"), r("lineitem"), r("part")))


def _c360_body() -> str:
    fills = ", ".join(f"coalesce({e}, 0) AS {e}" for e in _event_ints())
    return (
        f"SELECT * REPLACE ({fills}) FROM customers LEFT JOIN ({TXN_STATS_SQL}) b USING (customer_id) "
        f"LEFT JOIN ({_pivot_sql()}) e USING (customer_id) "
        f"LEFT JOIN (SELECT * EXCLUDE (recency_days) FROM ({LIFE_SQL})) l USING (customer_id)")


@query("customer_360", tidy_sql(O.with_views(_c360_body()), dbl=["txn_sum", "txn_mean", "txn_std"],
                                ints=["age", "txn_count"] + _event_ints(),
                                dates=["join_date", "first_txn", "last_txn"]))
def q_customer_360(spark, sf):
    from retention.operators.customer360 import customer_360
    from retention.operators.profile import txn_stats
    t = raw(spark, sf)
    return tidy(customer_360(t.customers, txn_stats(t.transactions), pivot_df(spark, sf), life_df(spark, sf)))


_OFFERS_SQL = ("SELECT CAST(user_id AS VARCHAR) AS customer_id, count(*) FILTER (WHERE event_type = 'view') AS offers_viewed, "
               "count(*) FILTER (WHERE event_type = 'purchase') AS offers_taken FROM events GROUP BY 1")


def offers_df(spark, sf) -> DataFrame:
    """Stand-in for the offers table: views and purchases of each customer."""
    kind = F.col("event_type")
    return fx.read_table(spark, sf, "events").groupBy(F.col("user_id").cast("string").alias("customer_id")).agg(
        F.count_if(kind == "view").alias("offers_viewed"), F.count_if(kind == "purchase").alias("offers_taken"))


def c360_offers_df(spark, sf) -> DataFrame:
    from retention.operators.customer360 import customer_360
    from retention.operators.profile import txn_stats
    t = raw(spark, sf)
    return customer_360(t.customers, txn_stats(t.transactions), pivot_df(spark, sf), life_df(spark, sf), offers_df(spark, sf))


def _c360_offers_sql() -> str:
    return f"SELECT * FROM ({_c360_body()}) LEFT JOIN ({_OFFERS_SQL}) o USING (customer_id)"


def _c360_types() -> dict:
    return {"dbl": ["txn_sum", "txn_mean", "txn_std"], "ints": ["age", "txn_count", "offers_viewed", "offers_taken"] + _event_ints(),
            "dates": ["join_date", "first_txn", "last_txn"]}


@query("customer_360_offers", tidy_sql(O.with_views(_c360_offers_sql()), **_c360_types()))
def q_customer_360_offers(spark, sf):
    """C8 with its offers join."""
    return tidy(c360_offers_df(spark, sf))


@query("customer_360_preview", tidy_sql(O.with_views(f"SELECT * FROM ({_c360_offers_sql()}) ORDER BY customer_id LIMIT 5"), **_c360_types()))
def q_customer_360_preview(spark, sf):
    """the first customers of the joined view."""
    from retention.operators.customer360 import preview
    return tidy(preview(c360_offers_df(spark, sf), "customer_id"))


@query("order_sets_concat", tidy_sql(
    "SELECT l_orderkey, l_partkey, l_linenumber, l_quantity, 'prior' AS eval_set FROM lineitem WHERE l_linestatus = 'F' UNION ALL "
    "SELECT l_orderkey, l_partkey, l_linenumber, l_quantity, 'train' FROM lineitem WHERE l_linestatus = 'O'",
    dbl=["l_quantity"], ints=["l_orderkey", "l_partkey", "l_linenumber"]))
def q_order_sets_concat(spark, sf):
    """Two frames of order lines, finished and open ones, under each other with their set's name."""
    from retention.operators.customer360 import concat_sets
    lines = fx.read_table(spark, sf, "lineitem")
    part = lambda status: lines.filter(F.col("l_linestatus") == status).select("l_orderkey", "l_partkey", "l_linenumber", "l_quantity")
    return tidy(concat_sets(prior=part("F"), train=part("O")))


# ---------------------------------------------------------------- Spark ML (M1-M5, M11, M13 trees, A18)

_MODELS: dict[tuple[str, str], tuple] = {}


def fitted_gbt(spark, sf):
    """The fitted model and the checkpointed training table that it was fitted and is validated on."""
    from retention.operators.model import GBTParams, train_model
    from retention.operators.split import training_set
    from retention.session import materialize
    features, labels = multi_features_df(spark, sf), multi_labels_df(spark, sf)
    training = materialize(training_set(features, labels))
    return train_model(features, labels, SPLIT_DATE, AS_OF, gp=GBTParams(), training=training)[0], training


def _held_gbt(spark, sf):
    """Fit once per session and scale factor (the queries that explain or check the model share it)."""
    from retention.session import app_key
    key = (app_key(spark), sf)
    if key not in _MODELS:
        _MODELS[key] = fitted_gbt(spark, sf)
    return _MODELS[key]


def gbt_model(spark, sf):
    return _held_gbt(spark, sf)[0]


@query("gbt_train_score")
def q_gbt_train_score(spark, sf):
    """Train (reference settings, anew each time), save and reload the pipeline (A18), score the validation split."""
    from retention.operators.model import predict
    from retention.operators.split import split
    st = _store(spark)
    fitted, training = fitted_gbt(spark, sf)
    st.save_model(fitted, AS_OF)
    model = st.load_model(AS_OF)
    val = split(training, SPLIT_DATE)[1]
    return tidy(predict(model, val, AS_OF, keep=("churn_label",)))


@query("gbt_tree_shap")
def q_gbt_tree_shap(spark, sf):
    from retention.operators.treeshap import explain
    from retention.session import scratch_path
    return tidy(explain(spark, gbt_model(spark, sf), multi_features_df(spark, sf), scratch_path(spark, "treeshap")))


@query("gbt_val_scores", tidy_sql(V(
    f"SELECT customer_id, snapshot_date, churn_label, TRUE AS in_range, TRUE AS class_agrees, TRUE AS reload_equal "
    f"FROM training WHERE NOT ({SPLIT_SQL}) AND snapshot_date > DATE '{SPLIT_DATE}'"),
    ints=["churn_label"], dates=["snapshot_date"]))
def q_gbt_val_scores(spark, sf):
    """M1-M5, A18, B20, B21 as invariants of every validation row: a probability, a class that agrees with
    it, and the same score from the model saved and loaded again."""
    from retention.operators.model import predict
    from retention.operators.split import split
    st, keys = _store(spark), ["customer_id", "snapshot_date"]
    model, training = _held_gbt(spark, sf)
    st.save_model(model, AS_OF)
    val = split(training, SPLIT_DATE)[1]
    one = predict(model, val, AS_OF, keep=("churn_label",))
    two = predict(st.load_model(AS_OF), val, AS_OF).select(*keys, F.col("churn_probability").alias("_again"))
    p = F.col("churn_probability")
    return tidy(one.join(two, keys, "left").select(
        *keys, "churn_label", p.between(0.0, 1.0).alias("in_range"),
        ((p > 0.5).cast("int") == F.col("churn_prediction")).alias("class_agrees"),
        p.eqNullSafe(F.col("_again")).alias("reload_equal")))


def _gate_rows() -> str:
    d = DEFAULT
    return (f"SELECT * FROM (VALUES ('auc', CAST({d.min_auc_threshold} AS DOUBLE), TRUE, TRUE), ('precision_at_target_recall', "
            f"CAST({d.min_precision_threshold} AS DOUBLE), TRUE, TRUE)) AS g(metric, minimum, in_range, status_agrees)")


@query("gbt_gate", tidy_sql(_gate_rows(), dbl=["minimum"]))
def q_gbt_gate(spark, sf):
    """The fitted model's metrics on all labelled rows, gated."""
    from retention.operators.model import evaluate
    _, gate = evaluate(gbt_model(spark, sf), multi_features_df(spark, sf), multi_labels_df(spark, sf), AS_OF)
    low = F.col("value") < F.col("minimum")
    return tidy(gate.select("metric", "minimum", F.col("value").between(0.0, 1.0).alias("in_range"),
                            (F.when(low, "warn").otherwise("ok") == F.col("status")).alias("status_agrees")))


def _tree_explanations(spark, sf) -> tuple[DataFrame, DataFrame]:
    """The checkpointed features and their attributions."""
    from retention.operators.treeshap import explain
    from retention.session import materialize, scratch_path
    feats = materialize(multi_features_df(spark, sf))
    return feats, materialize(explain(spark, gbt_model(spark, sf), feats, scratch_path(spark, "treeshap")))


@query("gbt_shap_additive", tidy_sql(V("SELECT customer_id, snapshot_date, TRUE AS additive FROM features4"),
                                     dates=["snapshot_date"]))
def q_gbt_shap_additive(spark, sf):
    """M13, M14 on trees: for every row the expected value and the attributions sum to the model's margin."""
    from pyspark.ml.functions import vector_to_array
    from retention.operators.model import model_columns, prepare
    model, keys = gbt_model(spark, sf), ["customer_id", "snapshot_date"]
    feats, explained = _tree_explanations(spark, sf)
    shap = [c for c in explained.columns if c.startswith("shap_")]
    total = F.col("expected_value")
    for c in shap:
        total = total + F.col(c)
    margin = model.transform(prepare(feats, model_columns(model))).select(
        *keys, vector_to_array("rawPrediction")[1].alias("_margin"))
    return tidy(explained.select(*keys, total.alias("_sum")).join(margin, keys, "left").select(
        *keys, (F.abs(F.col("_sum") - F.col("_margin")) <= 1e-6).alias("additive")))


@query("gbt_importance", tidy_sql(
    # the numeric features and the four product flags
    f"SELECT unnest(range(1, {len(O.NUMERIC_FILL) + 4} + 1)) AS rank, TRUE AS falling", ints=["rank"]))
def q_gbt_importance(spark, sf):
    """M15, M16 on trees: every model input has a rank, and importances don't rise with it."""
    from pyspark.sql import Window
    from retention.operators.explain import global_importance
    ranked = global_importance(_tree_explanations(spark, sf)[1])
    before = F.lag("importance").over(Window.orderBy("rank"))  # a row per feature
    return tidy(ranked.select("rank", ((F.col("importance") >= 0) & (F.coalesce(before >= F.col("importance"), F.lit(True)))).alias("falling")))


# ---------------------------------------------------------------- histogram boosting (M1 as the reference sets it, M2, M10, M11)

#: Candidate thresholds of the queries whose trees SQL grows as well.
BOOST_CUTS = {"txn_count_30d": [0, 1, 2, 4], "login_count_30d": [0, 1, 2], "days_since_last_txn": [0, 10, 30, 60],
              "tenure_days": [200, 600, 1200, 2000]}
BOOST_ROUNDS = 2


def _boost_params():
    from retention.operators.boosting import BoostParams
    return BoostParams(rounds=BOOST_ROUNDS, max_depth=2, row_sample=1.0, column_sample=1.0)


def small_boost(spark, sf):
    """Two trees of depth 2 over four features, on all training rows."""
    from retention.operators import boosting
    from retention.session import materialize
    rows = materialize(training_df(spark, sf))
    return boosting.fit(rows, list(BOOST_CUTS), p=_boost_params(), cuts=[list(map(float, c)) for c in BOOST_CUTS.values()]), rows


def _boost_ctes() -> list[str]:
    """CTEs that grow the trees by trying every threshold: ``t<round>_<level>`` has each row's node (as in a
    heap), ``best<round>_<level>`` the cut of each node, ``r<round>`` the margins after the round."""
    p = _boost_params()
    one = float(1 << 26)

    def score(g, h):
        return f"(({g}) / {one}) * (({g}) / {one}) / (({h}) / {one} + {p.reg_lambda})"

    cut_rows = [(f, j, name, cut) for f, (name, cuts) in enumerate(BOOST_CUTS.items()) for j, cut in enumerate(cuts)]
    out = [f"r0 AS (SELECT customer_id, snapshot_date, churn_label, {', '.join(f'CAST({n} AS DOUBLE) AS {n}' for n in BOOST_CUTS)}, "
           "CAST(0 AS DOUBLE) AS m FROM training)"]
    for k in range(BOOST_ROUNDS):
        prob = "(1.0::DOUBLE / (1.0::DOUBLE + exp(-m)))"
        out.append(f"t{k}_0 AS MATERIALIZED (SELECT *, round(({prob} - churn_label) * {one}) AS g, round({prob} * (1.0::DOUBLE - {prob}) * {one}) AS h, 0 AS node FROM r{k})")
        for level in range(p.max_depth):
            tries = " UNION ALL ".join(
                f"SELECT node, {f} AS f, {j} AS c, sum(g) AS g, sum(h) AS h, sum(CASE WHEN {name} <= {cut} THEN g ELSE 0 END) AS gl, "
                f"sum(CASE WHEN {name} <= {cut} THEN h ELSE 0 END) AS hl FROM t{k}_{level} WHERE node >= {2**level - 1} GROUP BY node"
                for f, j, name, cut in cut_rows)
            gain = f"{score('gl', 'hl')} + {score('g - gl', 'h - hl')} - {score('g', 'h')}"
            out.append(f"best{k}_{level} AS MATERIALIZED (SELECT * FROM (SELECT *, CASE WHEN hl >= {one} AND h - hl >= {one} THEN {gain} ELSE 0 END AS gain "
                       f"FROM ({tries})) QUALIFY row_number() OVER (PARTITION BY node ORDER BY gain DESC, f, c) = 1)")
            side = "CASE " + " ".join(f"WHEN b.f = {f} AND b.c = {j} THEN CASE WHEN t.{name} <= {cut} THEN 1 ELSE 2 END" for f, j, name, cut in cut_rows) + " END"
            out.append(f"t{k}_{level + 1} AS MATERIALIZED (SELECT t.* REPLACE (CASE WHEN b.gain > 1e-12 THEN 2 * t.node + {side} ELSE t.node END AS node) "
                       f"FROM t{k}_{level} t LEFT JOIN best{k}_{level} b USING (node))")
        out.append(f"w{k} AS MATERIALIZED (SELECT node, -(sum(g) / {one}) / (sum(h) / {one} + {p.reg_lambda}) AS value FROM t{k}_{p.max_depth} GROUP BY node)")
        out.append(f"r{k + 1} AS MATERIALIZED (SELECT t.* EXCLUDE (g, h, node) REPLACE (t.m + {p.learning_rate} * w.value AS m) FROM t{k}_{p.max_depth} t JOIN w{k} w USING (node))")
    return out


def _with_ctes(ctes: list[str], body: str) -> str:
    return V(f"SELECT * FROM (WITH {', '.join(ctes)} {body})")


def _boost_trees_sql() -> str:
    names = "CASE f " + " ".join(f"WHEN {f} THEN '{n}'" for f, n in enumerate(BOOST_CUTS)) + " END"
    cuts = "CASE " + " ".join(f"WHEN f = {f} AND c = {j} THEN {cut}" for f, cs in enumerate(BOOST_CUTS.values()) for j, cut in enumerate(cs)) + " END"
    parts = []
    for k in range(BOOST_ROUNDS):
        parts += [f"SELECT {k} AS tree, node, {names} AS feature, CAST({cuts} AS DOUBLE) AS threshold, CAST(NULL AS DOUBLE) AS value FROM best{k}_{level} WHERE gain > 1e-12"
                  for level in range(_boost_params().max_depth)]
        parts.append(f"SELECT {k}, node, NULL, NULL, value FROM w{k}")
    return _with_ctes(_boost_ctes(), " UNION ALL ".join(parts))


@query("boost_trees", tidy_sql(_boost_trees_sql(), dbl=["threshold", "value"], ints=["tree", "node"]))
def q_boost_trees(spark, sf):
    """M1: the trees of two rounds of histogram boosting, node by node (children of n are 2n + 1 and 2n + 2)."""
    model, _ = small_boost(spark, sf)
    rows = []
    for k, t in enumerate(model.trees):
        stack = [(0, 0)]
        while stack:
            node, name = stack.pop()
            if t.feature[node] < 0:
                rows.append((k, name, None, None, float(t.value[node])))
            else:
                rows.append((k, name, model.columns[t.feature[node]], float(t.threshold[node]), None))
                stack += [(t.left[node], 2 * name + 1), (t.right[node], 2 * name + 2)]
    return tidy(spark.createDataFrame(rows, "tree int, node int, feature string, threshold double, value double"))


@query("boost_scores", tidy_sql(_with_ctes(_boost_ctes(), f"SELECT customer_id, snapshot_date, churn_label, 1 / (1 + exp(-m)) AS churn_probability, "
                                           f"CAST(1 / (1 + exp(-m)) > 0.5 AS INTEGER) AS churn_prediction FROM r{BOOST_ROUNDS}"),
                                dbl=["churn_probability"], ints=["churn_label", "churn_prediction"], dates=["snapshot_date"]))
def q_boost_scores(spark, sf):
    """Every training row's probability under the two trees, saved and loaded again."""
    from retention.operators import boosting
    from retention.session import scratch_path
    model, rows = small_boost(spark, sf)
    path = scratch_path(spark, "boosted")
    boosting.save(spark, model, path)
    return tidy(boosting.predict(boosting.load(spark, path), rows, AS_OF, keep=("churn_label",)).drop("prediction_date"))


def _boost_views() -> dict[str, str]:
    """The usual views, the scores being those of the two trees."""
    scores = (f"SELECT customer_id, snapshot_date, churn_label, 1.0::DOUBLE / (1.0::DOUBLE + exp(-m)) AS churn_probability, "
              f"CAST(1.0::DOUBLE / (1.0::DOUBLE + exp(-m)) > 0.5 AS INTEGER) AS churn_prediction, DATE '{AS_OF}' AS prediction_date FROM r{BOOST_ROUNDS}")
    return _base_views() | {"scored": f"SELECT * FROM (WITH {', '.join(_boost_ctes())} {scores})"}


@query("boost_gate", tidy_sql(O.with_views(_GATE_SQL, _boost_views()), dbl=["value", "minimum"]))
def q_boost_gate(spark, sf):
    """A fitted model's AUC and precision at the target recall, and whether they pass."""
    from retention.operators import boosting
    from retention.operators.ranking import metrics, threshold_gate
    model, rows = small_boost(spark, sf)
    scored = metrics(boosting.predict(model, rows, AS_OF, keep=("churn_label",)), DEFAULT.target_recall)
    return tidy(threshold_gate(scored, DEFAULT.min_auc_threshold, DEFAULT.min_precision_threshold))


@query("boost_metrics", tidy_sql(O.with_views(_METRICS_SQL, _boost_views()), dbl=["auc", "precision", "recall", "f1", "precision_at_target_recall"],
                                 ints=["n_rows", "n_unscored"]))
def q_boost_metrics(spark, sf):
    """The metrics that training reports."""
    from retention.operators import boosting
    from retention.operators.ranking import metrics
    model, rows = small_boost(spark, sf)
    return tidy(metrics(boosting.predict(model, rows, AS_OF, keep=("churn_label",)), DEFAULT.target_recall))


def _phi_sql(j: int) -> str:
    """The attribution of feature j under the first tree by its definition: over all sets of the other
    features, what knowing j changes in the tree's conditional expectation."""
    import itertools
    import math
    names = list(BOOST_CUTS)

    def expected(known: frozenset, node: int) -> str:
        """The expected value from heap node ``node`` on; an unknown feature follows the covers."""
        if node >= 3:
            return f"v{node}"
        low, high = expected(known, 2 * node + 1), expected(known, 2 * node + 2)
        here = " ".join(f"WHEN f{node} = {f} AND c{node} = {c} THEN CASE WHEN {n} <= {cut} THEN {low} ELSE {high} END"
                        for f, (n, cuts) in enumerate(BOOST_CUTS.items()) if f in known for c, cut in enumerate(cuts))
        mixed = f"({low} * h{2 * node + 1} + {high} * h{2 * node + 2}) / (h{2 * node + 1} + h{2 * node + 2})"
        return f"CASE WHEN f{node} IS NULL THEN v{node} {here} ELSE {mixed} END"

    others = [i for i in range(len(names)) if i != j]
    terms = []
    for k in range(len(others) + 1):
        for s in itertools.combinations(others, k):
            weight = math.factorial(k) * math.factorial(len(others) - k) / math.factorial(len(names))
            terms.append(f"{weight!r}::DOUBLE * (({expected(frozenset({*s, j}), 0)}) - ({expected(frozenset(s), 0)}))")
    return " + ".join(terms)


def _boost_shap_sql() -> str:
    p = _boost_params()
    one = float(1 << 26)
    value = f"-(g / {one}) / (h / {one} + {p.reg_lambda})"
    stats = ("stats AS MATERIALIZED (SELECT node, any_value(g) AS g, any_value(h) AS h FROM (SELECT node, sum(g) AS g, sum(h) AS h FROM t0_1 GROUP BY node "
             "UNION ALL SELECT 0, sum(g), sum(h) FROM t0_0 UNION ALL SELECT node, sum(g), sum(h) FROM t0_2 GROUP BY node) GROUP BY node)")
    cells = ", ".join(f"max({value}) FILTER (node = {n}) AS v{n}, max(h) FILTER (node = {n}) AS h{n}" for n in range(7))
    cuts = ", ".join(f"(SELECT {x} FROM best0_{level} WHERE node = {n} AND gain > 1e-12) AS {x}{n}" for n, level in ((0, 0), (1, 1), (2, 1)) for x in "fc")
    tree = f"tree AS MATERIALIZED (SELECT *, {cuts} FROM (SELECT {cells} FROM stats))"
    phi = ", ".join(f"{p.learning_rate} * ({_phi_sql(j)}) AS shap_{n}" for j, n in enumerate(BOOST_CUTS))
    return _with_ctes([*_boost_ctes(), stats, tree], f"SELECT customer_id, snapshot_date, {phi} FROM r0, tree")


@query("boost_tree_shap", tidy_sql(_boost_shap_sql(), dbl=[f"shap_{n}" for n in BOOST_CUTS], dates=["snapshot_date"]))
def q_boost_tree_shap(spark, sf):
    """M13-M15 on trees: every row's attributions under the first tree."""
    from retention.operators.model import prepare
    from retention.operators.treeshap import explain_rows
    model, rows = small_boost(spark, sf)
    return tidy(explain_rows(spark, model.trees[:1], prepare(rows, model.columns), model.columns).drop("expected_value"))


# ---------------------------------------------------------------- second tier

_LAG_SQL = """SELECT customer_id, snapshot_date, txn_count_30d AS value,
  lag(txn_count_30d) OVER w AS lag_1, txn_count_30d - lag(txn_count_30d) OVER w AS delta_1,
  avg(txn_count_30d) OVER r AS rolling_mean_4, stddev_samp(txn_count_30d) OVER r AS rolling_std_4
FROM features4 WINDOW w AS (PARTITION BY customer_id ORDER BY snapshot_date),
  r AS (PARTITION BY customer_id ORDER BY snapshot_date ROWS BETWEEN 3 PRECEDING AND CURRENT ROW)"""


@query("lag_rolling", tidy_sql(V(_LAG_SQL), dbl=["rolling_mean_4", "rolling_std_4"],
                               ints=["value", "lag_1", "delta_1"], dates=["snapshot_date"]))
def q_lag_rolling(spark, sf):
    from retention.operators.segments import lag_rolling
    return tidy(lag_rolling(multi_features_df(spark, sf)))


def _fourier_sql() -> str:
    import math
    from retention.operators.segments import FOURIER_HARMONICS, FOURIER_PERIOD
    t = f"CAST(CAST(date_diff('day', CAST(timestamp AS DATE), DATE '{SNAPSHOT}') AS INTEGER) % {FOURIER_PERIOD} AS DOUBLE)"
    aggs = ["count(*) AS txn_rows"]
    for k in FOURIER_HARMONICS:
        ang = f"CAST('{2.0 * math.pi * k!r}' AS DOUBLE) * {t} / CAST('{float(FOURIER_PERIOD)!r}' AS DOUBLE)"
        aggs += [f"sum(cos({ang})) AS fourier_cos_{k}", f"sum(sin({ang})) AS fourier_sin_{k}"]
    return O.with_views(f"SELECT customer_id, {', '.join(aggs)} FROM transactions_clean WHERE "
                        f"{O.lookback_where(SNAPSHOT)} GROUP BY customer_id")


@query("fourier", tidy_sql(_fourier_sql(), dbl=["fourier_cos_1", "fourier_sin_1", "fourier_cos_2", "fourier_sin_2"],
                           ints=["txn_rows"]))
def q_fourier(spark, sf):
    from retention.operators.segments import fourier_features
    return tidy(fourier_features(cleaned(spark, sf).transactions, SNAPSHOT))


@query("churn_trend", tidy_sql(V("SELECT snapshot_date, count(*) AS customers, count(*) FILTER (WHERE churn_label = 1) "
                                 "AS churned, avg(CAST(churn_label AS DOUBLE)) AS churn_rate FROM labels4 GROUP BY 1"),
                               dbl=["churn_rate"], ints=["customers", "churned"], dates=["snapshot_date"]))
def q_churn_trend(spark, sf):
    from retention.operators.segments import churn_trend
    return tidy(churn_trend(multi_labels_df(spark, sf)))


# The features KMeans segments on.
SEGMENT_FEATURES = ["tenure_days", "txn_count_30d", "txn_amount_30d", "login_count_30d", "digital_engagement_score",
                    "days_since_last_txn"]


@query("segments")
def q_segments(spark, sf):
    from retention.operators.segments import kmeans_segments, segment_profiles
    from retention.session import materialize
    seg = kmeans_segments(materialize(training_df(spark, sf)), SEGMENT_FEATURES)
    return tidy(segment_profiles(seg, SEGMENT_FEATURES))


@query("segment_members", tidy_sql(V("SELECT customer_id, snapshot_date, TRUE AS nearest, (SELECT count(*) FROM training) "
                                     "AS members FROM training"), ints=["members"], dates=["snapshot_date"]))
def q_segment_members(spark, sf):
    """P5, P6 as invariants: each row once, in its nearest centre's segment; the profiles' sizes sum to all rows."""
    from retention.operators.segments import fit_segments, segment_profiles, with_nearest_check
    from retention.session import materialize
    rows = materialize(training_df(spark, sf))
    seg = with_nearest_check(fit_segments(rows, SEGMENT_FEATURES), rows, SEGMENT_FEATURES)
    members = segment_profiles(seg, SEGMENT_FEATURES).agg(F.sum("customers")).first()[0]
    return tidy(seg.select("customer_id", "snapshot_date", "nearest", F.lit(members).alias("members")))


def _segment_tree(spark, sf):
    """The segmented training rows, the tree that explains their segments, and its rules."""
    from retention.operators.segments import fit_segment_tree, kmeans_segments, leaf_rules
    from retention.session import materialize, scratch_path
    seg = materialize(kmeans_segments(materialize(training_df(spark, sf)), SEGMENT_FEATURES))
    tree = fit_segment_tree(seg, SEGMENT_FEATURES)
    return seg, tree, leaf_rules(tree, SEGMENT_FEATURES, scratch_path(spark, "segment-tree"))


@query("segment_rules")
def q_segment_rules(spark, sf):
    """The segments explained by the leaves of a tree, with support, purity and coverage."""
    from retention.operators.segments import rule_report
    seg, _, rules = _segment_tree(spark, sf)
    return tidy(rule_report(seg, rules))


@query("segment_rule_members", tidy_sql(V("SELECT customer_id, snapshot_date, 1 AS rules_held, TRUE AS as_the_tree, "
                                          "(SELECT count(*) FROM training) AS members FROM training"),
                                        ints=["rules_held", "members"], dates=["snapshot_date"]))
def q_segment_rule_members(spark, sf):
    """P5 as invariants: for each row exactly one rule holds, whose most frequent segment is what the fitted tree
    predicts; the rules' supports sum to all rows."""
    from pyspark.ml.functions import array_to_vector

    from retention.operators.segments import rule_report, with_rule
    seg, tree, rules = _segment_tree(spark, sf)
    report = rule_report(seg, rules)
    x = F.array(*[F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in SEGMENT_FEATURES])
    told = tree.transform(with_rule(seg, rules).withColumn("_features", array_to_vector(x)))
    held = sum((F.expr(r).cast("int") for r in rules), F.lit(0))
    rows = told.join(F.broadcast(report.select("rule_id", F.col("segment").alias("_told"))), "rule_id", "left")  # at most 2^depth rules
    members = report.agg(F.sum("support")).first()[0]
    return tidy(rows.select("customer_id", "snapshot_date", held.alias("rules_held"),
                            (F.col("prediction") == F.col("_told")).alias("as_the_tree"), F.lit(members).alias("members")))


def _segment_effects_sql() -> str:
    parts = []
    for c in SEGMENT_FEATURES:
        x = f"CAST(t.{c} AS DOUBLE)"
        own, rest = "t.churn_label = s.segment", "t.churn_label <> s.segment"
        n, m = f"count({x}) FILTER (WHERE {own})", f"count({x}) FILTER (WHERE {rest})"
        inside, outside = f"avg({x}) FILTER (WHERE {own})", f"avg({x}) FILTER (WHERE {rest})"
        squares = f"({n} * var_pop({x}) FILTER (WHERE {own}) + {m} * var_pop({x}) FILTER (WHERE {rest}))"
        parts.append(f"SELECT s.segment, '{c}' AS feature, count(*) FILTER (WHERE {own}) AS customers, {inside} AS mean_inside, "
                     f"{outside} AS mean_outside, ({inside} - {outside}) / nullif(sqrt({squares} / ({n} + {m} - 2)), 0) AS effect_size "
                     "FROM (SELECT DISTINCT churn_label AS segment FROM training) s, training t GROUP BY s.segment")
    return V(" UNION ALL ".join(parts))


@query("segment_effects", tidy_sql(_segment_effects_sql(), dbl=["mean_inside", "mean_outside", "effect_size"], ints=["segment", "customers"]))
def q_segment_effects(spark, sf):
    """Feature means and effect sizes per segment; the segments are those of the label, so that SQL can name them."""
    from retention.operators.segments import segment_effects
    return tidy(segment_effects(training_df(spark, sf).withColumn("segment", F.col("churn_label")), SEGMENT_FEATURES))


@query("segment_profile_means", tidy_sql(V("SELECT churn_label AS segment, count(*) AS customers, avg(churn_label) AS churn_rate, "
                                           + ", ".join(f"avg(CAST({c} AS DOUBLE)) AS mean_{c}" for c in SEGMENT_FEATURES)
                                           + " FROM training GROUP BY churn_label"),
                                         dbl=["churn_rate"] + [f"mean_{c}" for c in SEGMENT_FEATURES], ints=["segment", "customers"]))
def q_segment_profile_means(spark, sf):
    """Size, churn rate and feature means, of the label's segments as in ``segment_effects``."""
    from retention.operators.segments import segment_profiles
    return tidy(segment_profiles(training_df(spark, sf).withColumn("segment", F.col("churn_label")), SEGMENT_FEATURES))


#: Ends of the parts in which the stand-in's events arrive.
ARRIVALS = ["2023-11-15", "2023-12-20", "2024-01-08", "2024-01-16"]


def arrived_events(spark, sf, folder: str):
    """The raw fact tables as files that came one after another, by time; then the streams over them."""
    from retention.operators.features import historical
    from retention.streaming.events import event_stream
    t = raw(spark, sf)
    out = []
    for name, table in (("transactions", t.transactions), ("interactions", t.interactions)):
        begin = None
        for end in ARRIVALS:
            ts = F.col("timestamp")
            part = historical(table, SNAPSHOT).filter(ts < F.lit(f"{end} 00:00:00").cast("timestamp_ntz"))
            if begin is not None:
                part = part.filter(ts >= F.lit(f"{begin} 00:00:00").cast("timestamp_ntz"))
            part.coalesce(1).write.mode("append").parquet(f"{folder}/{name}")
            begin = end
        out.append(event_stream(spark, f"{folder}/{name}", table.schema))
    return out


@query("stream_event_features", tidy_sql(O.with_views(O.snapshot(SNAPSHOT)), money=MONEY, dbl=FEATURE_DBLS, ints=FEATURE_INTS, dates=DATES))
def q_stream_event_features(spark, sf):
    """P8 over events, E1 on a stream: events arrive in four parts; the state they leave gives the weekly snapshot."""
    from retention.session import scratch_path
    from retention.streaming.events import EventFeatures
    folder = scratch_path(spark, "events")
    events = EventFeatures(spark, f"{folder}/state")
    events.start(*arrived_events(spark, sf, folder)).awaitTermination()
    return tidy(events.features(cleaned(spark, sf).customers, SNAPSHOT), money=MONEY)


def _stream_sql() -> str:
    from retention.operators.scoring import LINEAR_INTERCEPT, LINEAR_WEIGHTS
    z = f"CAST({LINEAR_INTERCEPT} AS DOUBLE)" + "".join(
        f" + CAST({w} AS DOUBLE) * CAST({n} AS DOUBLE)" for n, w in LINEAR_WEIGHTS)
    prob = f"(0.5 + 0.5 * ({z}) / (1.0 + abs({z})))"
    return V(f"SELECT customer_id, snapshot_date, {prob} AS churn_probability, CAST({prob} > 0.5 AS INTEGER) "
             f"AS churn_prediction, DATE '{AS_OF}' AS prediction_date FROM features4")


@query("stream_score_linear", tidy_sql(_stream_sql(), dbl=["churn_probability"], ints=["churn_prediction"],
                                       dates=["snapshot_date", "prediction_date"]))
def q_stream_score_linear(spark, sf):
    """Feature files arrive in a folder; a stream scores them into an append-only sink."""
    from retention.operators.scoring import linear_score
    from retention.session import scratch_path
    from retention.streaming.scoring import score_stream
    src, out, ck = scratch_path(spark, "stream-in"), scratch_path(spark, "stream-out"), scratch_path(spark, "stream-ck")
    feats = multi_features_df(spark, sf)
    feats.write.mode("overwrite").partitionBy("snapshot_date").parquet(src)
    schema = spark.read.parquet(src).schema
    q = score_stream(spark, src, schema, lambda df: linear_score(df, AS_OF), out, ck)
    q.awaitTermination()
    return tidy(spark.read.parquet(out))


