"""Date literals and point-in-time window predicates.

Bounds are written as plain column-vs-literal tests on ``timestamp_ntz`` so
that Catalyst folds them and pushes them into the parquet scan.
"""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F


def to_day(s: str | date) -> date:
    return s if isinstance(s, date) else date.fromisoformat(str(s)[:10])


def shift(s: str | date, days: int) -> str:
    return (to_day(s) + timedelta(days=days)).isoformat()


def date_lit(s: str | date) -> Column:
    return F.lit(to_day(s).isoformat()).cast("date")


def midnight_lit(s: str | date) -> Column:
    """Midnight of day ``s`` as a ``timestamp_ntz`` literal (no session zone)."""
    return F.lit(f"{to_day(s).isoformat()} 00:00:00").cast("timestamp_ntz")


def ts_between_midnights(ts: Column, start: str | date, end: str | date) -> Column:
    """``start 00:00 <= ts <= end 00:00``, both ends inclusive."""
    return (ts >= midnight_lit(start)) & (ts <= midnight_lit(end))


def lookback(ts: Column, snapshot: str, window_days: int) -> Column:
    return ts_between_midnights(ts, shift(snapshot, -window_days), snapshot)


def lookahead(ts: Column, snapshot: str, horizon_days: int) -> Column:
    return ts_between_midnights(ts, shift(snapshot, 1), shift(snapshot, horizon_days))


def days_ago(snapshot: str | Column, ts: Column) -> Column:
    s = snapshot if isinstance(snapshot, Column) else date_lit(snapshot)
    return F.datediff(s, ts.cast("date"))


def is_midnight(ts: Column) -> Column:
    return ts == ts.cast("date").cast("timestamp_ntz")
