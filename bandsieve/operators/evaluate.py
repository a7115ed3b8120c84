"""Precision and recall against a gold set, confirm rates against the judge, and the history of both."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bandsieve.functions.bands import is_flagged
from bandsieve.functions.stats import round_to
from bandsieve.operators import versions
from bandsieve.schema import CHEAP_STAGES


def prf(tp: Column, predicted: Column, actual: Column) -> dict[str, Column]:
    """Precision, recall and F1 of set sizes, three decimals. Nothing predicted: precision 1 if nothing is actual, else 0. Nothing actual: recall 1."""
    p = F.when(predicted > 0, tp / predicted).when(actual == 0, 1.0).otherwise(0.0)
    r = F.when(actual > 0, tp / actual).otherwise(1.0)
    f = F.when(p + r > 0, 2 * p * r / (p + r)).otherwise(0.0)
    return {"precision": round_to(p, 3), "recall": round_to(r, 3), "f1": round_to(f, 3)}


def score_against_gold(rows: DataFrame, gold: DataFrame) -> DataFrame:
    """category, precision, recall, f1, n_gold over the gold clips that the stage's rows (path, verdict) cover."""
    both = gold.select(F.col("video").alias("path"), F.col("reasons").alias("actual")).join(rows.select("path", F.col("verdict.reasons").alias("predicted")), "path")
    none = F.array().cast("array<string>")
    side = lambda c, n: both.select("path", F.explode(F.array_distinct(F.coalesce(c, none))).alias("category"), F.lit(1).alias(n))
    cells = side("actual", "a").join(side("predicted", "p"), ["path", "category"], "full")
    n = cells.groupBy("category").agg(F.count_if(F.col("a").isNotNull() & F.col("p").isNotNull()).alias("tp"), F.count("p").alias("n_pred"), F.count("a").alias("n_gold"))
    return n.select("category", *[c.alias(k) for k, c in prf(F.col("tp"), F.col("n_pred"), F.col("n_gold")).items()], "n_gold")


def confirm(results: DataFrame) -> DataFrame:
    """stage, version, category (_overall or a reason), precision and n_gold: how many of the flags that the judge saw it confirmed."""
    judge = versions.latest_run(results.filter("stage = 'vlm'")).select("path", is_flagged(F.col("verdict")).alias("yes"))
    flagged = results.filter(F.col("stage").isin(*CHEAP_STAGES) & is_flagged(F.col("verdict"))).select("path", "stage", "version", F.coalesce("verdict.reasons", F.array().cast("array<string>")).alias("reasons"))
    rows = flagged.join(judge, "path").select("stage", "version", "yes", F.explode(F.concat(F.array(F.lit("_overall")), "reasons")).alias("category"))
    return rows.groupBy("stage", "version", "category").agg(round_to(F.avg(F.col("yes").cast("double")), 3).alias("precision"), F.count(F.lit(1)).alias("n_gold"))


def compare(history: DataFrame, stage: str) -> DataFrame:
    """version, category and the newest precision, recall and f1 of a stage's history."""
    last = Window.partitionBy("version", "category").orderBy(F.desc("ran_at"), F.desc("f1"))
    rows = history.filter(F.col("stage") == stage).withColumn("r", F.row_number().over(last)).filter("r = 1")
    return rows.select("version", "category", "precision", "recall", "f1")


def bootstrap(videos: DataFrame, n: int, seed: int = 0) -> DataFrame:
    """A draft gold set: n clips without reasons, to be filled in by hand."""
    from bandsieve.operators.cascade import sample_paths

    return sample_paths(videos.select("path"), n, seed).select(F.col("path").alias("video"), F.array().cast("array<string>").alias("reasons"), F.lit(None).cast("string").alias("_vlm"))


def compare_wide(history: DataFrame, stage: str, categories: list[str]) -> DataFrame:
    """version and the f1 of each category in a column of its own, null where a version has none. Naming the categories saves a pass over the history."""
    return compare(history, stage).groupBy("version").pivot("category", categories).agg(F.first("f1"))
