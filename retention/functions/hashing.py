"""Stable, partitioning-independent row selection by hashing a key.

``md5`` hex digests are equal in Spark and DuckDB, so the same rows are picked
in both engines and on every run, whatever the partitioning.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Digits of the digest that are compared: 60 bits, finer than a double's fraction.
HEX_DIGITS = 15


def hex_threshold(fraction: float, digits: int = HEX_DIGITS) -> str:
    """Lower-case hex string t such that ``prefix < t`` keeps ``fraction`` of the keys."""
    space = 16 ** digits
    n = max(0, min(space, round(fraction * space)))
    if n >= space:
        return "g" * digits  # above every hex prefix
    return format(n, f"0{digits}x")


def key_hash(key: Column) -> Column:
    return F.md5(key.cast("string"))


def split_predicate(key: Column, train_ratio: float) -> Column:
    """True for the training side of a customer-level split."""
    return F.substring(key_hash(key), 1, HEX_DIGITS) < F.lit(hex_threshold(train_ratio))
