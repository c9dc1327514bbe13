"""Small hand-made frames with the reference's input schemas (FIXTURES.md section 3)."""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql.types import StructField, StructType

from retention.sources import schemas


def _nullable(schema: StructType) -> StructType:
    """Declared schemas mark keys non-null; test frames must be able to break that."""
    return StructType([StructField(f.name, f.dataType, True) for f in schema.fields])


CUSTOMERS = _nullable(schemas.CUSTOMERS)
TRANSACTIONS = _nullable(schemas.TRANSACTIONS)
INTERACTIONS = _nullable(schemas.INTERACTIONS)

S = "2024-01-15"
S_DAY = date(2024, 1, 15)
S_TS = datetime(2024, 1, 15)


def customers(spark, rows):
    """rows: (customer_id, join_date[, has_cc, has_loan, has_ck, has_sv])"""
    full = []
    for r in rows:
        cid, jd = r[0], r[1]
        flags = r[2:] if len(r) > 2 else (True, False, True, False)
        full.append((cid, 40, "X", *flags, jd, "F"))
    return spark.createDataFrame(full, CUSTOMERS)


def transactions(spark, rows):
    """rows: (customer_id, timestamp[, amount, product, txn_type])"""
    full = []
    for r in rows:
        cid, ts = r[0], r[1]
        amount = r[2] if len(r) > 2 else 10.0
        product = r[3] if len(r) > 3 else "checking"
        ttype = r[4] if len(r) > 4 else "deposit"
        full.append((cid, product, amount, ttype, ts))
    return spark.createDataFrame(full, TRANSACTIONS)


def interactions(spark, rows):
    """rows: (customer_id, timestamp[, interaction_type, session_duration])"""
    full = []
    for r in rows:
        cid, ts = r[0], r[1]
        kind = r[2] if len(r) > 2 else "login"
        sess = r[3] if len(r) > 3 else 5
        full.append((cid, kind, ts, sess))
    return spark.createDataFrame(full, INTERACTIONS)


def day(offset: int, seconds: int = 0) -> datetime:
    return S_TS + timedelta(days=offset, seconds=seconds)
