"""Features and scores of customers as their events arrive (P8 over events, E1 on a stream).

Both fact tables are read as streams. Repeated rows within the watermark's delay are dropped, the
row rules of cleaning applied, and one streaming aggregate keeps the customer-day states of
``operators.daystate``. A day leaves the state store when the watermark has passed it, so the store
holds the days of the delay, not the history. Each micro-batch writes the states that changed to a
log in a folder of its own number, replaced if the batch is run again, so a restart or a lost
executor neither loses nor doubles any. The log's last row of a customer and day is its state.

Features of any date are merged from the log by the same code as in batch. A scorer, if given, scores
the customers of each micro-batch as of the midnight after its last event.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from retention.operators.daystate import DAY, STATES
from retention.operators.features import facts
from retention.operators.multisnap import features_from_states
from retention.operators.quality import declared_columns, row_rules
from retention.params import DEFAULT, Params

EVENT_TIME = "event_time"
SECONDS = 86_400
#: Longest that an event may come after a later one. Repeats further apart aren't found.
DELAY = "2 days"


def _arrived(events: DataFrame, table: str, delay: str) -> DataFrame:
    """A table's stream without repeated rows; ``event_time`` is the row's wall clock, whatever the session's zone."""
    stamped = events.select(*declared_columns(events, table)).withColumn(
        EVENT_TIME, F.from_utc_timestamp(F.col("timestamp").cast("timestamp"), F.current_timezone()))
    return row_rules(stamped.withWatermark(EVENT_TIME, delay).dropDuplicatesWithinWatermark(declared_columns(events, table)), table)


def day_state_stream(transactions: DataFrame, interactions: DataFrame, delay: str = DELAY) -> DataFrame:
    """(customer_id, day, states) of the days that the watermark hasn't passed, as a stream."""
    rows = facts(_arrived(transactions, "transactions", delay), _arrived(interactions, "interactions", delay), EVENT_TIME)
    rows = rows.withColumn("_midnight", F.col("timestamp") == F.col("timestamp").cast("date").cast("timestamp_ntz"))
    days = rows.groupBy("customer_id", F.window(EVENT_TIME, "1 day").alias("_w")).agg(*(c for s in STATES for c in s.columns()))
    return days.withColumn(DAY, (F.unix_seconds("_w.start") / SECONDS).cast("int")).drop("_w")


@dataclass
class EventFeatures:
    """The state log in ``folder`` and what is computed from it."""

    spark: SparkSession
    folder: str
    params: Params = DEFAULT

    @property
    def log(self) -> str:
        return f"{self.folder}/states"

    def start(self, transactions: DataFrame, interactions: DataFrame, customers: DataFrame | None = None,
              scorer: Callable[[DataFrame], DataFrame] | None = None, delay: str = DELAY) -> StreamingQuery:
        """Follow both streams until what is there is read. ``scorer`` turns a frame of features into scores."""
        def take(changed: DataFrame, batch: int) -> None:
            changed.write.mode("overwrite").parquet(f"{self.log}/batch={batch}")
            if scorer is not None:
                here = changed.sparkSession.read.parquet(f"{self.log}/batch={batch}")
                last = here.agg(F.max(DAY)).first()[0]
                if last is not None:
                    touched = here.select("customer_id").distinct()
                    scored = scorer(self.features(customers.join(touched, "customer_id", "left_semi"), _date(last + 1)))
                    scored.write.mode("overwrite").parquet(f"{self.folder}/scores/batch={batch}")

        stream = day_state_stream(transactions, interactions, delay)
        return (stream.writeStream.outputMode("update").option("checkpointLocation", f"{self.folder}/checkpoint")
                .foreachBatch(take).trigger(availableNow=True).start())

    def states(self) -> DataFrame:
        """(customer_id, day, states): the last written of each customer and day."""
        log = self.spark.read.option("basePath", self.log).parquet(self.log)
        latest = F.row_number().over(Window.partitionBy("customer_id", DAY).orderBy(F.col("batch").desc()))
        return log.withColumn("_n", latest).where("_n = 1").drop("_n", "batch")

    def features(self, customers: DataFrame, snapshot: str) -> DataFrame:
        """The features of a snapshot from what has arrived; equal to the batch plan's over the same events."""
        return features_from_states(self.spark, customers, self.states(), [snapshot], self.params)

    def compact(self, keep_from: str) -> "EventFeatures":
        """A log of one row a customer and day, without days before ``keep_from``, beside the old one."""
        name = f"{self.folder}/compact-{keep_from}"
        day = F.unix_date(F.lit(keep_from).cast("date"))
        out = EventFeatures(self.spark, name, self.params)
        self.states().where(F.col(DAY) >= day).write.mode("overwrite").parquet(f"{out.log}/batch=0")
        return out


def _date(day: int) -> str:
    import datetime as dt
    return (dt.date(1970, 1, 1) + dt.timedelta(days=day)).isoformat()


def event_stream(spark: SparkSession, folder: str, schema, files_per_trigger: int = 1) -> DataFrame:
    """Parquet files that arrive in a folder, ``files_per_trigger`` in a micro-batch."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(folder)
