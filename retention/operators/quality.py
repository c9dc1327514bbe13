"""Cleaning and data-quality reports.

Each report is one aggregate job per table that returns a long table
``(table_name, check_name, column_name, value, status)``; gates read that
small table instead of launching one job per column. ``clean_and_report`` and
``write_with_null_report`` take the same reports as observed metrics of the pass
that cleans or writes, so the gate has no scan of its own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from retention.functions.timewin import date_lit
from retention.params import DEFAULT, Params
from retention.session import scratch_path
from retention.sources.schemas import CRITICAL_COLUMNS, EXPECTED

FACT_TABLES = ("transactions", "interactions")
REPORT_COLUMNS = ["table_name", "check_name", "column_name", "value", "status"]


def declared_columns(df: DataFrame, table: str) -> list[str]:
    """Columns of the declared schema that the frame has (dedupe over these only)."""
    names = [f.name for f in EXPECTED[table].fields]
    return [c for c in names if c in df.columns] or df.columns


def dedupe(df: DataFrame, table: str | None = None) -> DataFrame:
    """Whole-row distinct over the declared columns."""
    cols = declared_columns(df, table) if table else df.columns
    return df.select(*cols).distinct()


def clamp_session(c: Column) -> Column:
    """Negative sessions become 0, null stays null."""
    return F.when(c < 0, F.lit(0)).otherwise(c)


def row_rules(df: DataFrame, table: str) -> DataFrame:
    """B6 (transactions: amount > 0) or B7 (interactions: clamp)."""
    if table == "transactions":
        return df.filter(F.col("amount") > 0)
    if table == "interactions":
        return df.withColumn("session_duration", clamp_session(F.col("session_duration")))
    return df


def clean(df: DataFrame, table: str) -> DataFrame:
    """Dedupe, then the table's row rules."""
    return row_rules(dedupe(df, table), table)


def elapsed_days(as_of: str, ts: Column) -> Column:
    """Whole days from ``ts`` to ``as_of`` 00:00, floored (as a timedelta's ``.days``)."""
    not_midnight = ts.cast("date").cast("timestamp_ntz") < ts
    return F.datediff(date_lit(as_of), ts.cast("date")) - F.when(not_midnight, 1).otherwise(0)


def _row(table: str, check: str, column: str | None, value: Column, status: Column) -> Column:
    return F.struct(F.lit(table).alias("table_name"), F.lit(check).alias("check_name"),
                    F.lit(column).cast("string").alias("column_name"),
                    value.cast("bigint").alias("value"), status.alias("status"))


def _checked(df: DataFrame, table: str) -> tuple[list[str], bool]:
    """The critical columns that the frame has, and whether its freshness is checked."""
    cols = declared_columns(df, table)
    return [c for c in CRITICAL_COLUMNS.get(table, []) if c in cols], table in FACT_TABLES and "timestamp" in cols


def _counted(df: DataFrame, table: str) -> DataFrame:
    """The distinct rows over the declared columns, each with its number ``_n``."""
    return df.groupBy(*declared_columns(df, table)).agg(F.count(F.lit(1)).alias("_n"))


def _report_aggregates(crit: list[str], fresh: bool) -> list[Column]:
    aggs = [F.sum("_n").alias("total"), F.count(F.lit(1)).alias("distinct_rows")]
    aggs += [F.sum(F.when(F.col(c).isNull(), F.col("_n"))).alias(f"null_{c}") for c in crit]
    return aggs + ([F.max("timestamp").alias("latest")] if fresh else [])


def _report_rows(a: DataFrame, table: str, crit: list[str], fresh: bool, as_of: str, p: Params) -> DataFrame:
    total = F.coalesce(F.col("total"), F.lit(0))
    dups = total - F.col("distinct_rows")
    rows = [
        _row(table, "row_count", None, total, F.lit("ok")),
        _row(table, "duplicates", None, dups, F.when(dups > 0, "warn").otherwise("ok")),
    ]
    for c in crit:
        n = F.coalesce(F.col(f"null_{c}"), F.lit(0))
        rows.append(_row(table, "critical_nulls", c, n, F.when(n > 0, "error").otherwise("ok")))
    if fresh:
        age = elapsed_days(as_of, F.col("latest"))
        rows.append(_row(table, "freshness_days", "timestamp", age,
                         F.when(age > p.max_staleness_days, "warn").otherwise("ok")))
    return a.select(F.inline(F.array(*rows)))


def table_report(df: DataFrame, table: str, as_of: str, p: Params = DEFAULT) -> DataFrame:
    """I1 + I2 + I3 for one table in a single aggregate job.

    Rows are first grouped by all declared columns (the distinct count), and the
    null counts and latest time ride on the same grouped rows.
    """
    crit, fresh = _checked(df, table)
    a = _counted(df, table).agg(*_report_aggregates(crit, fresh))
    return _report_rows(a, table, crit, fresh, as_of, p)


def _write_observed(df: DataFrame, aggregates: list[Column], path: str, finish=lambda rows: rows) -> DataFrame:
    """Write ``finish(df)`` to ``path`` and return the aggregates over ``df`` as one row.

    The aggregates are observed in the write's last stage, whose tasks count once each even if some
    are run again; ``finish`` must not add a shuffle.
    """
    spark = df.sparkSession
    schema = df.limit(0).agg(*aggregates).schema
    seen = Observation()
    finish(df.observe(seen, *aggregates)).write.parquet(path)
    found = seen.get
    return spark.createDataFrame([tuple(found.get(f.name) for f in schema.fields)], schema)


def clean_and_report(df: DataFrame, table: str, as_of: str, path: str, p: Params = DEFAULT) -> tuple[DataFrame, DataFrame]:
    """(cleaned rows, reread from ``path``; the rows of ``table_report``): one scan and one shuffle for both."""
    crit, fresh = _checked(df, table)
    a = _write_observed(_counted(df, table), _report_aggregates(crit, fresh), path,
                        lambda rows: row_rules(rows.drop("_n"), table))
    return df.sparkSession.read.parquet(path), _report_rows(a, table, crit, fresh, as_of, p)


def quality_report(raw: dict[str, DataFrame], as_of: str, p: Params = DEFAULT) -> DataFrame:
    """I8's report half: every check of every table as one long table."""
    out = None
    for name, df in raw.items():
        r = table_report(df, name, as_of, p)
        out = r if out is None else out.unionByName(r)
    return out


def perform_quality_checks(raw: dict[str, DataFrame], as_of: str, p: Params = DEFAULT,
                           raise_on_error: bool = True) -> tuple[DataFrame, dict[str, DataFrame]]:
    """I8: report (collected: a handful of rows), raise on critical nulls, return cleaned tables."""
    report = quality_report(raw, as_of, p).cache()
    if raise_on_error:
        raise_on_critical_nulls(report)
    return report, {name: clean(df, name) for name, df in raw.items()}


def clean_with_gates(raw: dict[str, DataFrame], as_of: str, p: Params = DEFAULT,
                     raise_on_error: bool = True) -> tuple[DataFrame, dict[str, DataFrame]]:
    """I8 as ``perform_quality_checks``, each table read once: its checks are observed while it is cleaned.

    The cleaned tables are Parquet in the shared folder; with critical nulls none is returned.
    """
    report, clean_tables = None, {}
    for name, df in raw.items():
        path = scratch_path(df.sparkSession, f"clean-{name}")
        clean_tables[name], rows = clean_and_report(df, name, as_of, path, p)
        report = rows if report is None else report.unionByName(rows)
    if raise_on_error:
        raise_on_critical_nulls(report)
    return report, clean_tables


def raise_on_critical_nulls(report: DataFrame) -> None:
    bad = report.filter(F.col("status") == "error").collect()
    if bad:
        desc = ", ".join(f"{r.table_name}.{r.column_name}={r.value}" for r in bad)
        raise ValueError(f"Critical columns have null values: {desc}")


def _null_aggregates(df: DataFrame, skip: tuple[str, ...]) -> tuple[list[str], list[Column]]:
    cols = [c for c in df.columns if c not in skip]
    return cols, [F.count(F.lit(1)).alias("_total"), *[F.count_if(F.col(c).isNull()).alias(c) for c in cols]]


def _null_rows(a: DataFrame, cols: list[str], p: Params) -> DataFrame:
    stacked = a.select(
        F.col("_total").alias("total_rows"),
        F.inline(F.array(*[F.struct(F.lit(c).alias("feature_name"), F.col(c).alias("null_count"))
                           for c in cols])))
    ratio = F.when(F.col("total_rows") > 0, F.col("null_count") / F.col("total_rows")).otherwise(F.lit(0.0))
    status = (F.when(ratio > p.null_error_ratio, "error").when(ratio > p.null_warn_ratio, "warn").otherwise("ok"))
    return stacked.withColumns({"null_ratio": ratio, "status": status})


def null_report(df: DataFrame, p: Params = DEFAULT,
                skip: tuple[str, ...] = ("customer_id", "snapshot_date")) -> DataFrame:
    """D9 + I4: null ratio of every feature column in one job, status error/warn/ok."""
    cols, aggs = _null_aggregates(df, skip)
    return _null_rows(df.agg(*aggs), cols, p)


def write_with_null_report(df: DataFrame, path: str, p: Params = DEFAULT,
                           skip: tuple[str, ...] = ("customer_id", "snapshot_date")) -> tuple[DataFrame, DataFrame]:
    """(the rows, reread from ``path``; their ``null_report``): the counts are observed while the rows are written."""
    cols, aggs = _null_aggregates(df, skip)
    a = _write_observed(df, aggs, path)
    return df.sparkSession.read.parquet(path), _null_rows(a, cols, p)


def enforce_null_report(report: DataFrame) -> None:
    """Raise like the reference when any feature is more than half null."""
    bad = report.filter(F.col("status") == "error").select("feature_name", "null_ratio").collect()
    if bad:
        raise ValueError("; ".join(f"Feature {r.feature_name} has {r.null_ratio:.2%} null values" for r in bad))


def schema_check(raw: dict[str, DataFrame], check_types: bool = False) -> DataFrame:
    """Per table and declared column, whether it is present (and of the declared type).

    Pure schema work: built from ``df.schema`` on the driver, no job.
    """
    from pyspark.sql import SparkSession
    rows = []
    for name, df in raw.items():
        actual = {f.name: f.dataType for f in df.schema.fields}
        for f in EXPECTED[name].fields:
            present = f.name in actual
            type_ok = present and (actual[f.name] == f.dataType)
            rows.append((name, f.name, f.dataType.simpleString(),
                         actual[f.name].simpleString() if present else None, present, type_ok))
    spark = SparkSession.getActiveSession()
    return spark.createDataFrame(
        rows, "table_name string, column_name string, declared_type string, actual_type string, "
              "present boolean, type_matches boolean")


def schema_scan(raw: dict[str, DataFrame]) -> DataFrame:
    """One aggregate per table: for each declared column the rows, and the nulls where it may
    not be null."""
    out = None
    for name, df in raw.items():
        fields = EXPECTED[name].fields
        missing = [F.count_if(F.col(f.name).isNull() & F.lit(not f.nullable)).alias(f"_m{i}") for i, f in enumerate(fields)]
        one = df.agg(F.count(F.lit(1)).alias("n_rows"), *missing)
        columns = F.array(*(F.struct(F.lit(f.name).alias("column_name"), F.col(f"_m{i}").alias("n_missing")) for i, f in enumerate(fields)))
        rows = one.select(F.lit(name).alias("table_name"), "n_rows", F.explode(columns).alias("_c")).select(
            "table_name", "_c.column_name", "n_rows", "_c.n_missing")
        out = rows if out is None else out.unionByName(rows)
    return out


def validate_schemas(raw: dict[str, DataFrame], check_types: bool = False) -> None:
    """A6 gate: missing declared columns raise; types only with ``check_types``."""
    for name, df in raw.items():
        actual = {f.name: f.dataType for f in df.schema.fields}
        missing = [f.name for f in EXPECTED[name].fields if f.name not in actual]
        if missing:
            raise ValueError(f"Missing fields in {name}: {set(missing)}")
        if check_types:
            wrong = [f.name for f in EXPECTED[name].fields if actual[f.name] != f.dataType]
            if wrong:
                raise ValueError(f"Wrong types in {name}: {set(wrong)}")
