"""Customer 360 and basket views.

All joins are on one key, so the per-customer parts (each already grouped by
``customer_id``) line up on the same hash partitioning and only the customer
side is shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from retention.functions.timewin import date_lit

# Event types of the pivot, in the order of their columns.
EVENT_TYPES = ["click", "error", "purchase", "signup", "view"]

OTHER_EVENTS = "other"

# Lifecycle buckets by days since last activity (upper bound exclusive).
LIFECYCLE_BUCKETS = [(15, "active"), (45, "dormant"), (60, "at-risk")]
LIFECYCLE_ELSE = "lost"


def event_pivot(events: DataFrame, key: str = "customer_id", kind: str = "event_type",
                values: list[str] = EVENT_TYPES) -> DataFrame:
    """Count per key x event type, 0 where none; types outside the list (and null) count
    in ``other``. The explicit list avoids an extra distinct job and fixes the columns."""
    named = F.when(F.col(kind).isin(values), F.col(kind)).otherwise(OTHER_EVENTS)
    columns = [*values, OTHER_EVENTS]
    return events.withColumn(kind, named).groupBy(key).pivot(kind, columns).count().na.fill(0, columns)


def lifecycle_state(recency_days: Column) -> Column:
    """B25 as a CASE expression (the reference applies a Python function per row)."""
    expr = None
    for bound, name in LIFECYCLE_BUCKETS:
        expr = F.when(recency_days < bound, name) if expr is None else expr.when(recency_days < bound, name)
    return expr.otherwise(LIFECYCLE_ELSE)


def lifecycle(last: DataFrame, as_of: str) -> DataFrame:
    """Recency in days from last activity to ``as_of`` and its bucket (never active -> lost)."""
    rec = F.datediff(date_lit(as_of), F.col("last_activity").cast("date"))
    return last.select("customer_id", rec.alias("recency_days"), lifecycle_state(rec).alias("lifecycle_state"))


def order_products(lineitem: DataFrame) -> DataFrame:
    """Every order line with its set, in one scan: prior (finished), train (open), other."""
    cols = ["l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_extendedprice"]
    status = F.col("l_linestatus")
    return lineitem.select(*cols, F.when(status == "F", "prior").when(status == "O", "train").otherwise("other").alias("eval_set"))


def concat_sets(**sets: DataFrame) -> DataFrame:
    """Frames of order lines under each other, each row with its frame's name; columns by name."""
    out = None
    for name, df in sets.items():
        named = df.withColumn("eval_set", F.lit(name))
        out = named if out is None else out.unionByName(named)
    return out


def basket_join(orders: DataFrame, lineitem: DataFrame, part: DataFrame) -> DataFrame:
    """Orders x order lines x products, inner on order id and product id.

    Products are a dimension; Spark broadcasts them when their measured size is
    under the threshold, else sort-merges.
    """
    op = order_products(lineitem)
    o = orders.select(F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("customer_key"),
                      F.col("o_orderdate").alias("order_date"))
    p = part.select(F.col("p_partkey").alias("product_id"), F.col("p_name").alias("product_name"),
                    F.col("p_type").alias("product_type"))
    j = o.join(op.withColumnRenamed("l_orderkey", "order_id").withColumnRenamed("l_partkey", "product_id"),
               "order_id")
    return j.join(p, "product_id").select(
        "order_id", "customer_key", "order_date", "product_id", "product_name", "product_type",
        F.col("l_linenumber").alias("line_number"), F.col("l_quantity").alias("quantity"),
        F.col("l_extendedprice").alias("price"), "eval_set")


def fill_zero_if_present(df: DataFrame, columns: list[str]) -> DataFrame:
    """Fill nulls with 0 in the named columns that exist."""
    present = [c for c in columns if c in df.columns]
    return df.na.fill(0, present) if present else df


def customer_360(demographics: DataFrame, behavioral: DataFrame, events_pivot: DataFrame,
                 life: DataFrame, offers: DataFrame | None = None) -> DataFrame:
    """Demographics left-joined to behaviour, event pivot, lifecycle (recency dropped,
    B23) and optional offers, then event counts 0-filled (B26)."""
    out = (demographics.join(behavioral, "customer_id", "left")
           .join(events_pivot, "customer_id", "left")
           .join(life.drop("recency_days"), "customer_id", "left"))
    if offers is not None:
        out = out.join(offers, "customer_id", "left")
    return fill_zero_if_present(out, [*EVENT_TYPES, OTHER_EVENTS])


def preview(df: DataFrame, *order: str, n: int = 5) -> DataFrame:
    """the first rows by ``order`` for a look (a limit is the feature here)."""
    return df.orderBy(*order).limit(n)
