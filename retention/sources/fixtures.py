"""Views over the driver-generated tables that give the reference's input schemas.

Facts from the TPC-H-like tables are shifted by ``DAY_SHIFT`` days so that
2001-06-15 lands on 2024-01-15. The same definitions exist as DuckDB text in
``DUCKDB_VIEWS`` for the oracle.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from retention.session import app_key

# Fixed value: the day shift of the fixture views.
DAY_SHIFT = 8249


@dataclass(frozen=True)
class Tables:
    customers: DataFrame
    transactions: DataFrame
    interactions: DataFrame

    def as_dict(self) -> dict[str, DataFrame]:
        return {"customers": self.customers, "transactions": self.transactions,
                "interactions": self.interactions}


_READS: dict[tuple[str, str], DataFrame] = {}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The driver's read-only input tables, one relation per application.

    Re-reading a path lists its files and reads footers on the driver each time;
    these inputs never change, so the scan relation is built once and reused by
    every plan (each plan still prunes columns and pushes filters on its own).
    """
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    key = (app_key(spark), path)
    if key not in _READS:
        _READS[key] = spark.read.parquet(path)
    return _READS[key]


def _shift(c):
    return c + F.expr(f"INTERVAL {DAY_SHIFT} DAYS")


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_quantity", "l_extendedprice", "l_discount",
        "l_returnflag", "l_linestatus", "l_shipdate")
    od = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    j = li.join(od, F.col("l_orderkey") == F.col("o_orderkey"))
    product = (F.when(F.col("o_orderpriority") == "1-URGENT", "credit_card")
               .when(F.col("o_orderpriority") == "2-HIGH", "loan")
               .when(F.col("o_orderpriority") == "3-MEDIUM", "checking")
               .when(F.col("o_orderpriority") == "4-NOT SPECIFIED", "savings")
               .otherwise("debit"))
    sign = F.when((F.col("l_linestatus") == "F") & (F.col("l_quantity") < 3), F.lit(-1.0)).otherwise(F.lit(1.0))
    txn_type = (F.when(F.col("l_returnflag") == "A", "deposit")
                .when(F.col("l_returnflag") == "N", "withdrawal")
                .otherwise("fee"))
    return j.select(
        F.col("o_custkey").cast("string").alias("customer_id"),
        product.alias("product"),
        (sign * F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("amount"),
        txn_type.alias("txn_type"),
        _shift(F.col("l_shipdate")).alias("timestamp"),
    )


def interactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = read_table(spark, sf_dir, "events").select("user_id", "event_type", "ts", "value")
    itype = (F.when(F.col("event_type") == "signup", "login")
             .when(F.col("event_type") == "click", "web")
             .when(F.col("event_type") == "view", "mobile")
             .when(F.col("event_type") == "error", "support")
             .otherwise("email_click"))
    session = F.when(F.col("event_type").isin("signup", "click", "view"),
                     F.floor("value").cast("int") - 1)
    return ev.select(
        F.col("user_id").cast("string").alias("customer_id"),
        itype.alias("interaction_type"),
        F.col("ts").alias("timestamp"),
        session.alias("session_duration"),
    )


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    n = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    o = (read_table(spark, sf_dir, "orders")
         .groupBy("o_custkey")
         .agg(F.bool_or(F.col("o_orderpriority") == "1-URGENT").alias("cc"),
              F.bool_or(F.col("o_orderpriority") == "2-HIGH").alias("ln"),
              F.bool_or(F.col("o_orderpriority") == "3-MEDIUM").alias("ck"),
              F.bool_or(F.col("o_orderpriority") == "4-NOT SPECIFIED").alias("sv"),
              _shift(F.min("o_orderdate")).cast("date").alias("join_date")))
    j = (c.join(n, F.col("c_nationkey") == F.col("n_nationkey"))
         .join(o, F.col("c_custkey") == F.col("o_custkey")))
    gender = (F.when(F.col("c_custkey") % 3 == 0, "M")
              .when(F.col("c_custkey") % 3 == 1, "F").otherwise("Other"))
    return j.select(
        F.col("c_custkey").cast("string").alias("customer_id"),
        (F.lit(18) + (F.col("c_custkey") % 67).cast("int")).alias("age"),
        F.col("n_name").alias("state"),
        F.col("cc").alias("has_credit_card"),
        F.col("ln").alias("has_loan"),
        F.col("ck").alias("has_checking"),
        F.col("sv").alias("has_savings"),
        F.col("join_date"),
        gender.alias("gender"),
    )


_VIEWS: dict[tuple[str, str], Tables] = {}


def tables(spark: SparkSession, sf_dir: str) -> Tables:
    """The three fixture views (immutable plans, built once per application)."""
    key = (app_key(spark), sf_dir.rstrip("/"))
    if key not in _VIEWS:
        _VIEWS[key] = Tables(customers(spark, sf_dir), transactions(spark, sf_dir), interactions(spark, sf_dir))
    return _VIEWS[key]


# DuckDB text of the same three views, used as CTEs by the oracle SQL.
DUCKDB_VIEWS = {
    "transactions": f"""
select cast(o_custkey as varchar) as customer_id,
  case o_orderpriority when '1-URGENT' then 'credit_card' when '2-HIGH' then 'loan'
    when '3-MEDIUM' then 'checking' when '4-NOT SPECIFIED' then 'savings' else 'debit' end as product,
  case when l_linestatus='F' and l_quantity<3 then -1.0 else 1.0 end
    * l_extendedprice*(1-l_discount) as amount,
  case l_returnflag when 'A' then 'deposit' when 'N' then 'withdrawal' else 'fee' end as txn_type,
  l_shipdate + interval '{DAY_SHIFT}' day as timestamp
from lineitem join orders on l_orderkey=o_orderkey""",
    "interactions": """
select cast(user_id as varchar) as customer_id,
  case event_type when 'signup' then 'login' when 'click' then 'web' when 'view' then 'mobile'
    when 'error' then 'support' else 'email_click' end as interaction_type,
  ts as timestamp,
  case when event_type in ('signup','click','view') then cast(floor(value) as int)-1 end as session_duration
from events""",
    "customers": f"""
select cast(c.c_custkey as varchar) as customer_id, 18 + cast(c.c_custkey % 67 as int) as age,
  n_name as state, o.cc as has_credit_card, o.ln as has_loan, o.ck as has_checking, o.sv as has_savings,
  o.join_date, case c.c_custkey % 3 when 0 then 'M' when 1 then 'F' else 'Other' end as gender
from customer c join nation on c_nationkey=n_nationkey
join (select o_custkey, bool_or(o_orderpriority='1-URGENT') cc, bool_or(o_orderpriority='2-HIGH') ln,
        bool_or(o_orderpriority='3-MEDIUM') ck, bool_or(o_orderpriority='4-NOT SPECIFIED') sv,
        cast(min(o_orderdate)+interval '{DAY_SHIFT}' day as date) join_date
      from orders group by o_custkey) o on c.c_custkey=o.o_custkey""",
}
