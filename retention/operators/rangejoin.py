"""Point-in-range join as an equi-join on a bucket id.

Spark has no native range join; a bare inequality join becomes a nested loop.
Here each range row ``[lo, hi]`` (integers, e.g. day numbers) is exploded over
the buckets ``floor(lo/B) .. floor(hi/B)`` it touches and each point row gets
``floor(p/B)``; the equi-join on the bucket plus the exact range test gives the
same rows. With ``B`` about the range width every range touches at most two
buckets, and the join is a hash join that Spark may broadcast (small range
side) or sort-merge (large range side) without a Cartesian product.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKET = "_rj_bucket"


def day_number(c: Column) -> Column:
    """Days since 1970-01-01 of a date or timestamp column."""
    return F.unix_date(c.cast("date"))


SALT = "_rj_salt"
DEFAULT_SALT = 32


def range_join(points: DataFrame, point: Column, ranges: DataFrame, lo: Column, hi: Column,
               bucket_size: int, broadcast_ranges: bool = False, salt: int | None = None) -> DataFrame:
    """Inner join of ``points`` with every range of ``ranges`` that holds ``point`` (ends inclusive).

    ``broadcast_ranges`` is for callers that know the range side is small (a
    bounded parameter list): no shuffle of the points at all. Otherwise the join
    is shuffled on the bucket id, which has few distinct values (one per
    ``bucket_size`` span), so it is salted: each point gets a salt from a hash of
    its own columns (deterministic, so a retried task sends every row to the
    same place), each range is copied once per salt value, and the join key is
    (bucket, salt). ``salt`` defaults to ``DEFAULT_SALT`` on that path.
    """
    b = F.lit(int(bucket_size))
    r = ranges.withColumn(BUCKET, F.explode(F.sequence(F.floor(lo / b), F.floor(hi / b))))
    p = points.withColumn(BUCKET, F.floor(point / b))
    keys = [BUCKET]
    if broadcast_ranges:
        r = F.broadcast(r)
    else:
        k = DEFAULT_SALT if salt is None else int(salt)
        if k > 1:
            p = p.withColumn(SALT, F.pmod(F.hash(*[F.col(c) for c in points.columns]), F.lit(k)))
            r = r.withColumn(SALT, F.explode(F.sequence(F.lit(0), F.lit(k - 1))))
            keys.append(SALT)
    out = p.join(r, keys).filter((point >= lo) & (point <= hi))
    return out.drop(*keys)
