"""Scoring feature rows as they arrive.

Scoring is stateless, so the stream is a plain ``readStream`` over a folder of
parquet feature files, the same scoring plan as batch, and an append-mode file
sink whose checkpoint (in the shared checkpoint folder) gives exactly-once
output across restarts and lost executors.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType


def score_stream(spark: SparkSession, source_dir: str, schema: StructType,
                 scorer: Callable[[DataFrame], DataFrame], sink_dir: str, checkpoint_dir: str,
                 available_now: bool = True, max_files_per_trigger: int | None = None) -> StreamingQuery:
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    scored = scorer(reader.parquet(source_dir))
    writer = (scored.writeStream.format("parquet").outputMode("append")
              .option("checkpointLocation", checkpoint_dir).option("path", sink_dir))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="10 seconds")
    return writer.start()
