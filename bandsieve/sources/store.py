"""The results store as Parquet, and scratch tables in the shared folder."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from bandsieve.schema import EVAL, RESULTS, RUNS, VIDEOS
from bandsieve.session import shared_base


def scratch_path(spark: SparkSession) -> str:
    """A new folder under the one that the driver and all executors share."""
    return f"{shared_base(spark)}/bandsieve-{uuid.uuid4().hex}"


def exists(spark: SparkSession, path: str) -> bool:
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(folder)


def checkpointed(df: DataFrame) -> DataFrame:
    """Writes a table to the shared folder and reads it back: cuts lineage, survives lost executors."""
    path = scratch_path(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class Store:
    """Tables videos, results (partitioned by stage and version), runs and eval under one folder. Rows are only ever appended;
    a row that replaces another is resolved when read."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _read(self, name: str, schema) -> DataFrame:  # noqa: ANN001
        if not exists(self.spark, f"{self.path}/{name}"):
            return self.spark.createDataFrame([], schema)
        rows = self.spark.read.schema(schema).parquet(f"{self.path}/{name}")
        return rows.select([f.name for f in schema.fields])

    def videos(self) -> DataFrame:
        return self._read("videos", VIDEOS)

    def results(self) -> DataFrame:
        """The last row written of each path, stage and version."""
        return upsert_view(self._read("results", RESULTS))

    def runs(self) -> DataFrame:
        return self._read("runs", RUNS)

    def history(self) -> DataFrame:
        return self._read("eval", EVAL)

    def add_videos(self, new: DataFrame) -> None:
        """Adds paths that are not there yet."""
        rows = insert_if_absent(self.videos(), new.select([f.name for f in VIDEOS.fields]), ["path"])
        checkpointed(rows).write.mode("append").parquet(f"{self.path}/videos")

    def add_results(self, rows: DataFrame) -> None:
        rows.select([f.name for f in RESULTS.fields]).write.mode("append").partitionBy("stage", "version").parquet(f"{self.path}/results")

    def add_run(self, stage: str, version: str, started: float, finished: float, n_done: int) -> None:
        run_id = (self.runs().agg(F.max("run_id")).first()[0] or 0) + 1
        self.spark.createDataFrame([(run_id, stage, version, None, started, finished, n_done)], RUNS).write.mode("append").parquet(f"{self.path}/runs")

    def add_eval(self, rows: DataFrame) -> None:
        rows.select([F.col(f.name).cast(f.dataType) for f in EVAL.fields]).write.mode("append").parquet(f"{self.path}/eval")


def upsert_view(rows: DataFrame, keys: tuple[str, ...] = ("path", "stage", "version"), at: str = "ran_at") -> DataFrame:
    """The newest row of each key; of rows with equal times any one, always the same."""
    others = [F.to_json(F.struct(*[c for c in rows.columns if c not in keys]))]
    order = Window.partitionBy(*keys).orderBy(F.desc(at), *others)
    return rows.withColumn("_r", F.row_number().over(order)).filter("_r = 1").drop("_r")


def insert_if_absent(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """New rows whose key is in neither the old table nor an earlier one of the batch."""
    return new.dropDuplicates(keys).join(old.select(*keys), keys, "left_anti")
