"""Clip scores from tables of frames."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def blocked_and_still(frames: DataFrame) -> DataFrame:
    """black_frac (luma < 16), blur_frac (sharpness < 100) and med_motion (1 for one frame) of frames (path, luma, sharpness, motion)."""
    return frames.groupBy("path").agg(F.avg(F.when(F.col("luma") < 16, 1.0).otherwise(0.0)).alias("black_frac"), F.avg(F.when(F.col("sharpness") < 100, 1.0).otherwise(0.0)).alias("blur_frac"), F.coalesce(F.median("motion"), F.lit(1.0)).alias("med_motion"))


def motion(frames: DataFrame, value: str = "luma") -> DataFrame:
    """Adds the distance to the frame before, in units of 255; null for the first."""
    before = F.lag(value).over(Window.partitionBy("path").orderBy("i"))
    return frames.withColumn("motion", F.abs(F.col(value) - before) / 255)


def winning_groups(scores: DataFrame) -> DataFrame:
    """Of scores (path, i, group, sim): the share of a clip's frames that each group wins; ties go to the first group."""
    best = scores.groupBy("path", "i").agg(F.min_by("group", F.struct(-F.col("sim"), "group")).alias("group"))
    n = F.sum(F.count(F.lit(1))).over(Window.partitionBy("path"))
    return best.groupBy("path", "group").agg((F.count(F.lit(1)) / n).alias("frac"))


def subsample(n: int, most: int = 6) -> list[int]:
    """Places of at most `most` evenly spaced frames of n."""
    return list(range(0, n, max(1, n // most)))[:most]


def mean_pool(vectors: DataFrame, key: str = "path", vector: str = "vector") -> DataFrame:
    """The mean vector of each key, dimension by dimension; partial sums before the shuffle."""
    cells = vectors.select(key, F.posexplode(vector).alias("d", "x")).groupBy(key, "d").agg(F.avg(F.col("x").cast("double")).alias("x"))
    return cells.groupBy(key).agg(F.transform(F.array_sort(F.collect_list(F.struct("d", "x"))), lambda c: c["x"]).alias("pooled"))
