"""Shared by the operators: table reads and Arrow-batch helpers."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from retention.session import ship_package

#: Words are maximal runs of anything but these six code points (fixed by the query contracts).
SPACE_CLASS = r"[\x20\x09-\x0D]"
#: Rows in a batch that a task writes at once; bounds a worker's memory for outputs.
OUT_ROWS = 2_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts_of(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text): only the two columns read, so columns of other names can't clash; null text is empty."""
    return docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))


def map_rows(df: DataFrame, rows: Callable[[Iterator[dict]], Iterator[tuple]], schema: str) -> DataFrame:
    """``mapInArrow`` for a generator over row dicts: reads Arrow batches, writes batches of ``OUT_ROWS``."""
    ship_package(df.sparkSession)
    fields = df.sparkSession.createDataFrame([], schema).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(fields)

        def source() -> Iterator[dict]:
            for b in batches:
                names = b.schema.names
                # slices: a batch's Python objects are made a few rows at a time
                for at in range(0, b.num_rows, 512):
                    part = b.slice(at, 512)
                    for values in zip(*(c.to_pylist() for c in part.columns)):
                        yield dict(zip(names, values))

        held: list[tuple] = []
        for row in rows(source()):
            held.append(row)
            if len(held) >= OUT_ROWS:
                yield _batch(held, arrow)
                held = []
        if held:
            yield _batch(held, arrow)

    return df.mapInArrow(run, fields)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
