"""Output shaping shared by the query catalog and its DuckDB oracle.

Dates and timestamps become ISO strings, integers become BIGINT, doubles are
rounded to 4 places as ``floor(x * 1e4 + 0.4999) / 1e4``: one IEEE multiply, add
and floor, so both engines round an equal double to an equal double (the
built-in ``round`` breaks exact midpoints differently in each engine). The
boundary sits just off the midpoint because averages of 4-decimal amounts land
exactly on 5th-decimal midpoints, where summation order would pick the side.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
FRACTIONAL = (T.FloatType, T.DoubleType, T.DecimalType)
TEMPORAL = (T.DateType, T.TimestampType, T.TimestampNTZType)


SCALE = 10000.0
OFFSET = 0.4999


def round4(c):
    return F.floor(c * F.lit(SCALE) + F.lit(OFFSET)).cast("double") / F.lit(SCALE)


def tidy(df: DataFrame, money: tuple[str, ...] | list[str] = ()) -> DataFrame:
    """One ``selectExpr`` (a single call into the JVM) with a cast or round per column."""
    exprs = []
    for f in df.schema.fields:
        q = f"`{f.name}`"
        if isinstance(f.dataType, TEMPORAL):
            e = f"CAST({q} AS STRING)"
        elif isinstance(f.dataType, INTEGRAL):
            e = f"CAST({q} AS BIGINT)"
        elif isinstance(f.dataType, FRACTIONAL):
            e = f"CAST(FLOOR(CAST({q} AS DOUBLE) * {SCALE}D + {OFFSET}D) AS DOUBLE) / {SCALE}D"
        else:
            e = q
        exprs.append(f"{e} AS {q}")
    return df.selectExpr(*exprs)


def tidy_sql(inner: str, dbl=(), ints=(), dates=(), money=()) -> str:
    """DuckDB side of ``tidy``: list the columns that need a cast or a round."""
    reps = [f"floor(CAST({c} AS DOUBLE) * {SCALE} + {OFFSET}) / {SCALE} AS {c}" for c in list(dbl) + list(money)]
    reps += [f"CAST({c} AS BIGINT) AS {c}" for c in ints]
    reps += [f"CAST({c} AS VARCHAR) AS {c}" for c in dates]
    if not reps:
        return inner
    return f"SELECT * REPLACE ({', '.join(reps)}) FROM ({inner}) AS _q"
