"""DuckDB text of the same plans, for the driver's side-by-side correctness check.

Builders return SQL fragments over the fixture views (``DUCKDB_VIEWS``); the
catalog wraps them with ``with_views`` and ``tidy_sql``.
"""

from __future__ import annotations

from retention.functions.timewin import shift
from retention.params import DEFAULT, Params
from retention.sources.fixtures import DUCKDB_VIEWS

CLEAN_VIEWS = {
    "transactions_clean": "SELECT * FROM (SELECT DISTINCT customer_id, product, amount, txn_type, timestamp "
                          "FROM transactions) WHERE amount > 0",
    "interactions_clean": "SELECT customer_id, interaction_type, timestamp, "
                          "CASE WHEN session_duration < 0 THEN 0 ELSE session_duration END AS session_duration "
                          "FROM (SELECT DISTINCT customer_id, interaction_type, timestamp, session_duration "
                          "FROM interactions)",
}


def with_views(body: str, extra: dict[str, str] | None = None) -> str:
    ctes = dict(DUCKDB_VIEWS)
    ctes.update(CLEAN_VIEWS)
    if extra:
        ctes.update(extra)
    return "WITH " + ",\n".join(f"{k} AS ({v})" for k, v in ctes.items()) + "\n" + body


def d(s: str) -> str:
    return f"DATE '{s}'"


def ts(s: str) -> str:
    return f"TIMESTAMP '{s} 00:00:00'"


def days_ago(s: str) -> str:
    return f"CAST(date_diff('day', CAST(timestamp AS DATE), {d(s)}) AS INTEGER)"


def eligible(s: str, p: Params = DEFAULT) -> str:
    return f"SELECT * FROM customers WHERE join_date <= {d(shift(s, -p.minimum_tenure_days))}"


def lookback_where(s: str, p: Params = DEFAULT) -> str:
    return f"timestamp >= {ts(shift(s, -p.feature_window_days))} AND timestamp <= {ts(s)}"


def lookahead_where(s: str, p: Params = DEFAULT) -> str:
    return f"timestamp >= {ts(shift(s, 1))} AND timestamp <= {ts(shift(s, p.churn_horizon_days))}"


def demographic(src: str, s: str) -> str:
    return (f"SELECT *, CAST(date_diff('day', join_date, {d(s)}) AS INTEGER) AS tenure_days, "
            "CAST(has_credit_card AS INTEGER) + CAST(has_loan AS INTEGER) + CAST(has_checking AS INTEGER) "
            f"+ CAST(has_savings AS INTEGER) AS active_products_count FROM ({src})")


def txn_features(s: str, src: str = "transactions_clean", p: Params = DEFAULT) -> str:
    return f"""SELECT customer_id,
  count(*) FILTER (WHERE d <= 30) AS txn_count_30d,
  count(*) FILTER (WHERE d <= 60) AS txn_count_60d,
  count(*) FILTER (WHERE d <= 90) AS txn_count_90d,
  sum(amount) FILTER (WHERE d <= 30) AS txn_amount_30d,
  sum(amount) FILTER (WHERE d <= 60) AS txn_amount_60d,
  sum(amount) FILTER (WHERE d <= 90) AS txn_amount_90d,
  avg(amount) FILTER (WHERE d <= 30) AS avg_txn_amount_30d,
  min(d) AS days_since_last_txn,
  min(d) FILTER (WHERE txn_type = 'deposit') AS days_since_last_deposit,
  count(*) FILTER (WHERE d <= 30 AND product = 'checking') AS checking_txn_count_30d,
  count(*) FILTER (WHERE d <= 30 AND product = 'credit_card') AS credit_card_txn_count_30d,
  count(*) FILTER (WHERE d <= 30 AND product = 'savings') AS savings_txn_count_30d,
  count(*) FILTER (WHERE d <= 30 AND txn_type = 'deposit') AS deposit_count_30d,
  count(*) FILTER (WHERE d <= 30 AND txn_type = 'withdrawal') AS withdrawal_count_30d,
  count(*) FILTER (WHERE d <= 30 AND txn_type = 'fee') AS fee_count_30d,
  CASE WHEN count(*) FILTER (WHERE d <= 60) > 0
       THEN count(*) FILTER (WHERE d <= 30) / count(*) FILTER (WHERE d <= 60) ELSE 0 END AS txn_trend_30d_vs_60d
FROM (SELECT *, {days_ago(s)} AS d FROM {src} WHERE {lookback_where(s, p)})
GROUP BY customer_id"""


def interaction_features(s: str, src: str = "interactions_clean", p: Params = DEFAULT) -> str:
    return f"""SELECT *,
  CASE WHEN login_count_60d > 0 THEN login_count_30d / login_count_60d ELSE 0 END AS login_trend_30d_vs_60d,
  CASE WHEN mobile_usage_30d + web_usage_30d > 0
       THEN mobile_usage_30d / (mobile_usage_30d + web_usage_30d) ELSE 0 END AS mobile_usage_ratio_30d
FROM (SELECT customer_id,
  count(*) FILTER (WHERE d <= 30 AND interaction_type = 'login') AS login_count_30d,
  count(*) FILTER (WHERE d <= 60 AND interaction_type = 'login') AS login_count_60d,
  count(*) FILTER (WHERE d <= 90 AND interaction_type = 'login') AS login_count_90d,
  min(d) FILTER (WHERE interaction_type = 'login') AS days_since_last_login,
  count(*) FILTER (WHERE d <= 30 AND interaction_type = 'support') AS support_interactions_30d,
  count(*) FILTER (WHERE d <= 30 AND interaction_type = 'mobile') AS mobile_usage_30d,
  count(*) FILTER (WHERE d <= 30 AND interaction_type = 'web') AS web_usage_30d,
  avg(session_duration) FILTER (WHERE d <= 30 AND session_duration > 0) AS avg_session_duration_30d,
  max(session_duration) FILTER (WHERE d <= 30) AS max_session_duration_30d
FROM (SELECT *, {days_ago(s)} AS d FROM {src} WHERE {lookback_where(s, p)})
GROUP BY customer_id)"""


NUMERIC_FILL = [
    "age", "tenure_days", "active_products_count",
    "txn_count_30d", "txn_count_60d", "txn_count_90d", "txn_amount_30d", "txn_amount_60d",
    "txn_amount_90d", "avg_txn_amount_30d", "days_since_last_txn", "days_since_last_deposit",
    "checking_txn_count_30d", "credit_card_txn_count_30d", "savings_txn_count_30d",
    "deposit_count_30d", "withdrawal_count_30d", "fee_count_30d", "txn_trend_30d_vs_60d",
    "login_count_30d", "login_count_60d", "login_count_90d", "days_since_last_login",
    "support_interactions_30d", "mobile_usage_30d", "web_usage_30d", "avg_session_duration_30d",
    "max_session_duration_30d", "login_trend_30d_vs_60d", "mobile_usage_ratio_30d",
    "relationship_score", "digital_engagement_score",
]


def snapshot(s: str, p: Params = DEFAULT, txn_src: str = "transactions_clean",
             int_src: str = "interactions_clean", cust_src: str = "customers") -> str:
    """D4 for one snapshot date: a full SELECT with a DATE ``snapshot_date``."""
    elig = f"SELECT * FROM {cust_src} WHERE join_date <= {d(shift(s, -p.minimum_tenure_days))}"
    joined = (f"SELECT dm.*, t.* EXCLUDE (customer_id), i.* EXCLUDE (customer_id) "
              f"FROM ({demographic(elig, s)}) dm "
              f"LEFT JOIN ({txn_features(s, txn_src, p)}) t USING (customer_id) "
              f"LEFT JOIN ({interaction_features(s, int_src, p)}) i USING (customer_id)")
    derived = ("SELECT *, active_products_count * 2 + CASE WHEN avg_txn_amount_30d > 1000 THEN 1 ELSE 0 END "
               "+ CASE WHEN login_count_30d > 10 THEN 1 ELSE 0 END AS relationship_score, "
               "login_count_30d + mobile_usage_30d + web_usage_30d AS digital_engagement_score "
               f"FROM ({joined})")
    fills = ", ".join(f"coalesce({c}, 0) AS {c}" for c in NUMERIC_FILL)
    return f"SELECT * REPLACE ({fills}), {d(s)} AS snapshot_date FROM ({derived})"


def qualifying_activity(s: str, p: Params = DEFAULT) -> str:
    return (f"SELECT DISTINCT customer_id FROM (SELECT customer_id FROM transactions_clean WHERE "
            f"{lookahead_where(s, p)} UNION ALL SELECT customer_id FROM interactions_clean WHERE "
            f"{lookahead_where(s, p)} AND session_duration > 0)")


def churn_labels(s: str, p: Params = DEFAULT) -> str:
    act = qualifying_activity(s, p)
    elig = f"SELECT customer_id FROM customers WHERE join_date <= {d(shift(s, -p.minimum_tenure_days))}"
    return (f"SELECT customer_id, 0 AS churn_label, CAST(NULL AS DATE) AS churned_date, {d(s)} AS snapshot_date "
            f"FROM ({act}) UNION ALL "
            f"SELECT customer_id, 1 AS churn_label, {d(s)} AS churned_date, {d(s)} AS snapshot_date "
            f"FROM ({elig}) e WHERE NOT EXISTS (SELECT 1 FROM ({act}) a WHERE a.customer_id = e.customer_id)")
