"""Dated raw scans (A1-A4), CSV scan (A13) and the parquet export."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from retention.operators.quality import validate_schemas
from retention.sources.schemas import EXPECTED

RAW_TABLES = ("customers", "transactions", "interactions")


def dated_path(raw_root: str, table: str, data_date: str) -> str:
    return f"{raw_root.rstrip('/')}/{table}/{data_date}"


def load_table(spark: SparkSession, raw_root: str, table: str, data_date: str,
               declared: bool = False) -> DataFrame:
    """A1-A3. ``declared`` reads with the declared schema instead of the file's."""
    reader = spark.read.schema(EXPECTED[table]) if declared else spark.read
    return reader.parquet(dated_path(raw_root, table, data_date))


def ingest(spark: SparkSession, raw_root: str, data_date: str, declared: bool = False,
           check_types: bool = False) -> dict[str, DataFrame]:
    """A4: the three dated tables, schema-checked by name (A6; types on request)."""
    raw = {t: load_table(spark, raw_root, t, data_date, declared) for t in RAW_TABLES}
    validate_schemas(raw, check_types)
    return raw


def truncate_to_millis(df: DataFrame, col: str = "timestamp") -> DataFrame:
    """Keep millisecond precision only."""
    c = F.col(col)
    return df.withColumn(col, F.date_trunc("millisecond", c).cast(df.schema[col].dataType))


def export_parquet(df: DataFrame, path: str, drop: tuple[str, ...] = (), millis: str | None = None) -> None:
    """A14 (+ B23 drop columns, + B24 timestamp precision)."""
    out = df.drop(*drop)
    if millis:
        out = truncate_to_millis(out, millis)
    out.write.mode("overwrite").parquet(path)


def write_dated(raw: dict[str, DataFrame], raw_root: str, data_date: str) -> None:
    for name, df in raw.items():
        df.write.mode("overwrite").parquet(dated_path(raw_root, name, data_date))


def write_csv_gz(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).option("compression", "gzip").csv(path)


def read_csv(spark: SparkSession, path: str, schema: T.StructType, partitions: int | None = None) -> DataFrame:
    """Header CSV (gzip allowed) with a declared schema, no inference pass.

    A gzip file is not splittable, so one file is one task; ``partitions``
    spreads the rows out again for the work that follows.
    """
    df = spark.read.option("header", True).option("mode", "FAILFAST").schema(schema).csv(path)
    return df.repartition(partitions) if partitions else df


# Types of a CSV column from narrow to wide, each with the test that a value has it. A column has
# the first that all its values have; where none fits, or there are no values, it is a string.
_WHOLE = r"^[+-]?[0-9]+$"
CSV_TYPES: list[tuple[T.DataType, object]] = [
    (T.IntegerType(), lambda c: c.rlike(_WHOLE) & c.try_cast("int").isNotNull()),
    (T.LongType(), lambda c: c.rlike(_WHOLE) & c.try_cast("bigint").isNotNull()),
    (T.DoubleType(), lambda c: ~c.rlike(r"^\s|\s$") & c.try_cast("double").isNotNull()),
    (T.DateType(), lambda c: c.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$") & c.try_cast("date").isNotNull()),
    (T.TimestampType(), lambda c: c.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}([T ][0-9:.]+.*)?$") & c.try_cast("timestamp").isNotNull()),
    (T.BooleanType(), lambda c: F.lower(c).isin("true", "false")),
]


def infer_csv_schema(spark: SparkSession, path: str) -> T.StructType:
    """The column types of header CSV files by one aggregate over all rows of all files.

    Each task finds for each column which types all its values have; the flags are merged by AND, so
    the result doesn't depend on how rows are dealt out. Null and empty values have every type."""
    text = spark.read.option("header", True).csv(path)
    held = text.agg(*(F.bool_and(F.when(F.col(f"`{c}`").isNotNull(), test(F.col(f"`{c}`")))).alias(f"{i}_{j}") for i, c in enumerate(text.columns) for j, (_, test) in enumerate(CSV_TYPES))).first()
    fields = []
    for i, c in enumerate(text.columns):
        fits = [kind for j, (kind, _) in enumerate(CSV_TYPES) if held[f"{i}_{j}"]]
        fields.append(T.StructField(c, fits[0] if fits else T.StringType()))
    return T.StructType(fields)


def read_csv_inferred(spark: SparkSession, path: str, partitions: int | None = None) -> DataFrame:
    """A13 without a declared schema: types by ``infer_csv_schema``, then one typed scan."""
    return read_csv(spark, path, infer_csv_schema(spark, path), partitions)
