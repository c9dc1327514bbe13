"""Date-partitioned feature and label store (A7-A12), model store.

Features and labels live in *sibling* roots (``features/``, ``labels/``) with a
Hive-style ``snapshot_date=YYYY-MM-DD`` layout written by ``partitionBy``.
Writes use dynamic partition overwrite, so re-running one date replaces only
that date. They are rebalanced by date: AQE merges small dates into one task and
splits large ones at its advisory size
(``spark.sql.adaptive.advisoryPartitionSizeInBytes``), so a date of b shuffled
bytes has about b / advisory files and never less than one, for any number of
dates; within a file rows are sorted by customer. Reads name the folders of the
dates that they want: one date lists one folder, a range lists the root's folder
names and then the files of the dates within it.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from retention.functions.timewin import date_lit, to_day


@dataclass(frozen=True)
class FeatureStore:
    spark: SparkSession
    root: str

    @property
    def features_root(self) -> str:
        return f"{self.root.rstrip('/')}/features"

    @property
    def labels_root(self) -> str:
        return f"{self.root.rstrip('/')}/labels"

    @property
    def models_root(self) -> str:
        return f"{self.root.rstrip('/')}/models"

    # -- writes
    def _write(self, df: DataFrame, path: str, snapshot_date: str | None, files_per_date: int | None) -> None:
        if snapshot_date is not None:
            df = df.withColumn("snapshot_date", date_lit(snapshot_date))
        df = df.withColumn("snapshot_date", F.col("snapshot_date").cast("date"))
        # ``files_per_date`` fixes the number of files instead: rows are shuffled to
        # (date, hash bucket of the customer), each written by one task.
        if files_per_date:
            bucket = F.pmod(F.hash(F.col("customer_id")), F.lit(int(files_per_date)))
            df = df.repartition(F.col("snapshot_date"), bucket)
        else:
            df = df.hint("rebalance", "snapshot_date")
        (df.sortWithinPartitions("snapshot_date", "customer_id").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
           .partitionBy("snapshot_date").parquet(path))

    def store_features(self, df: DataFrame, snapshot_date: str | None = None,
                       files_per_date: int | None = None) -> None:
        self._write(df, self.features_root, snapshot_date, files_per_date)

    def store_labels(self, df: DataFrame, snapshot_date: str | None = None,
                     files_per_date: int | None = None) -> None:
        self._write(df, self.labels_root, snapshot_date, files_per_date)

    # -- reads (A9-A12)
    def _date_folders(self, root: str, start: str, end: str) -> list[str]:
        """The root's folders of the dates from ``start`` to ``end``: one listing of names, no files."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(root)
        fs = path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        names = [x.getPath().getName() for x in fs.listStatus(path)]
        first, last = (f"snapshot_date={to_day(d).isoformat()}" for d in (start, end))
        return [f"{root}/{n}" for n in sorted(names) if first <= n <= last]

    def _read(self, root: str, start: str, end: str) -> DataFrame:
        """The dates from ``start`` to ``end``; a frame without rows where none is stored."""
        reader = self.spark.read.option("basePath", root)
        if to_day(start) == to_day(end):
            try:
                return reader.parquet(f"{root}/snapshot_date={to_day(start).isoformat()}")
            except AnalysisException as e:
                if e.getCondition() != "PATH_NOT_FOUND":
                    raise
        folders = self._date_folders(root, start, end)
        if folders:
            return reader.parquet(*folders)
        return reader.parquet(root).filter(F.lit(False))

    def load_features(self, snapshot_date: str) -> DataFrame:
        return self._read(self.features_root, snapshot_date, snapshot_date)

    def load_labels(self, snapshot_date: str) -> DataFrame:
        return self._read(self.labels_root, snapshot_date, snapshot_date)

    def load_features_range(self, start: str, end: str) -> DataFrame:
        return self._read(self.features_root, start, end)

    def load_labels_range(self, start: str, end: str) -> DataFrame:
        return self._read(self.labels_root, start, end)

    # -- models
    def model_path(self, run_date: str) -> str:
        return f"{self.models_root}/churn_model_{to_day(run_date).strftime('%Y%m%d')}"

    def save_model(self, model, run_date: str) -> str:
        path = self.model_path(run_date)
        model.write().overwrite().save(path)
        return path

    def load_model(self, run_date: str):
        from pyspark.ml import PipelineModel
        return PipelineModel.load(self.model_path(run_date))
