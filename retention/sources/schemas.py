"""Declared input and output schemas (A5)."""

from __future__ import annotations

from pyspark.sql import types as T

# The declared schemas of the three raw tables.
CUSTOMERS = T.StructType([
    T.StructField("customer_id", T.StringType(), False),
    T.StructField("age", T.IntegerType(), True),
    T.StructField("state", T.StringType(), True),
    T.StructField("has_credit_card", T.BooleanType(), True),
    T.StructField("has_loan", T.BooleanType(), True),
    T.StructField("has_checking", T.BooleanType(), True),
    T.StructField("has_savings", T.BooleanType(), True),
    T.StructField("join_date", T.DateType(), False),
    T.StructField("gender", T.StringType(), True),
])

TRANSACTIONS = T.StructType([
    T.StructField("customer_id", T.StringType(), False),
    T.StructField("product", T.StringType(), False),
    T.StructField("amount", T.DoubleType(), False),
    T.StructField("txn_type", T.StringType(), False),
    T.StructField("timestamp", T.TimestampNTZType(), False),
])

INTERACTIONS = T.StructType([
    T.StructField("customer_id", T.StringType(), False),
    T.StructField("interaction_type", T.StringType(), False),
    T.StructField("timestamp", T.TimestampNTZType(), False),
    T.StructField("session_duration", T.IntegerType(), True),
])

EXPECTED = {"customers": CUSTOMERS, "transactions": TRANSACTIONS, "interactions": INTERACTIONS}

# Columns that may never be null, per table (gate I2).
CRITICAL_COLUMNS = {
    "customers": ["customer_id", "join_date"],
    "transactions": ["customer_id", "amount", "timestamp"],
    "interactions": ["customer_id", "timestamp"],
}

LABELS = T.StructType([
    T.StructField("customer_id", T.StringType(), True),
    T.StructField("churn_label", T.IntegerType(), False),
    T.StructField("churned_date", T.DateType(), True),
    T.StructField("snapshot_date", T.DateType(), True),
])

PREDICTIONS = T.StructType([
    T.StructField("customer_id", T.StringType(), True),
    T.StructField("churn_probability", T.DoubleType(), True),
    T.StructField("churn_prediction", T.IntegerType(), True),
    T.StructField("prediction_date", T.DateType(), True),
])

KEY_COLUMNS = ("customer_id", "snapshot_date")
LABEL_COLUMNS = ("churn_label", "churned_date")
