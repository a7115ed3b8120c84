"""Four ways to say which version of a stage's rows counts."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from bandsieve.schema import ACTIVE_VERSIONS


def active(results: DataFrame, versions: dict[str, str] = ACTIVE_VERSIONS) -> DataFrame:
    """Rows of each stage's active version."""
    keep = F.lit(False)
    for stage, version in versions.items():
        keep = keep | ((F.col("stage") == stage) & (F.col("version") == version))
    return results.filter(keep)


def most_rows_versions(results: DataFrame) -> DataFrame:
    """stage, version: the version with most rows; ties go to the first in order."""
    counts = results.groupBy("stage", "version").agg(F.count(F.lit(1)).alias("n"))
    first = Window.partitionBy("stage").orderBy(F.desc("n"), "version")
    return counts.withColumn("r", F.row_number().over(first)).filter("r = 1").select("stage", "version", "n")


def latest_run_versions(results: DataFrame) -> DataFrame:
    """stage, version: that of the stage's newest row; ties go to the first in order."""
    newest = results.groupBy("stage", "version").agg(F.max("ran_at").alias("at"))
    first = Window.partitionBy("stage").orderBy(F.desc("at"), "version")
    return newest.withColumn("r", F.row_number().over(first)).filter("r = 1").select("stage", "version")


def most_rows(results: DataFrame) -> DataFrame:
    """Rows of each stage's most populated version. One row a stage is broadcast."""
    return results.join(F.broadcast(most_rows_versions(results).select("stage", "version")), ["stage", "version"], "left_semi")


def latest_run(results: DataFrame) -> DataFrame:
    return results.join(F.broadcast(latest_run_versions(results)), ["stage", "version"], "left_semi")


def latest_per_clip(results: DataFrame) -> DataFrame:
    """The newest row of each clip and stage."""
    newest = Window.partitionBy("path", "stage").orderBy(F.desc("ran_at"), "version")
    return results.withColumn("_r", F.row_number().over(newest)).filter("_r = 1").drop("_r")
