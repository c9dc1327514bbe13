"""Guarded arithmetic (ANSI mode raises on division by zero)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ratio(num: Column, den: Column, default: float = 0.0) -> Column:
    return F.when(den > 0, num / den).otherwise(F.lit(default))


def count_if(cond: Column) -> Column:
    return F.count(F.when(cond, F.lit(1)))
