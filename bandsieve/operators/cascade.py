"""Gates, todo lists, funnels and verdicts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bandsieve.functions.bands import DEFAULT_BANDS, Bands, decide, is_flagged, judge_label
from bandsieve.operators import versions
from bandsieve.schema import CHEAP_STAGES, STAGES

#: Reasons that need no judge.
HARD = ("black", "empty", "corrupt", "probe_fail", "decode_fail", "error")


def rung(stage: Column | None = None) -> Column:
    """A stage's place among the rungs."""
    s = F.col("stage") if stage is None else stage
    out = F.when(s == STAGES[0], 0)
    for i, name in enumerate(STAGES[1:], 1):
        out = out.when(s == name, i)
    return out


def good_from(results: DataFrame, stage: str) -> DataFrame:
    """Clips that any version of a stage stored as good."""
    return results.filter((F.col("stage") == stage) & (F.col("verdict.decision") == "good")).select("path").distinct()


def unsure_any(results: DataFrame) -> DataFrame:
    """Clips that any cheap stage but the first stored as unsure."""
    return results.filter(F.col("stage").isin(*CHEAP_STAGES[1:]) & (F.col("verdict.decision") == "unsure")).select("path").distinct()


def gate(results: DataFrame, stage: str) -> DataFrame | None:
    """Clips that a stage may look at; None: all."""
    if stage == "vlm":
        return unsure_any(results)
    place = CHEAP_STAGES.index(stage) if stage in CHEAP_STAGES else 0
    return good_from(results, CHEAP_STAGES[place - 1]) if place else None


def undone(videos: DataFrame, results: DataFrame, stage: str, version: str, allowed: DataFrame | None = None) -> DataFrame:
    """Paths without a row of this stage and version, of those the gate allows."""
    done = results.filter((F.col("stage") == stage) & (F.col("version") == version)).select("path")
    todo = videos.select("path").join(done, "path", "left_anti")
    return todo.join(allowed, "path", "left_semi") if allowed is not None else todo


def clean_candidates(videos: DataFrame, results: DataFrame) -> DataFrame:
    """Paths that were never judged and never flagged by any row."""
    seen = results.filter((F.col("stage") == "vlm") | is_flagged(F.col("verdict"))).select("path")
    return videos.select("path").join(seen, "path", "left_anti")


def sample_paths(paths: DataFrame, n: int, seed: int | str = 0) -> DataFrame:
    """n paths in the order of a hash: a repeatable random sample by a bounded top-k."""
    return paths.orderBy(F.md5(F.concat(F.lit(f"{seed}:"), "path")), "path").limit(n)


def first_exit(results: DataFrame, bands: Bands = DEFAULT_BANDS) -> DataFrame:
    """path, stage, decision of each clip's first rung that isn't good. One shuffle, by clip, of small rows."""
    cheap = results.filter(F.col("stage").isin(*CHEAP_STAGES))
    decided = cheap.select("path", "stage", rung().alias("ord"), decide(bands).alias("decision")).filter("decision <> 'good'")
    first = decided.groupBy("path").agg(F.min_by(F.struct("stage", "decision"), "ord").alias("x"))
    return first.select("path", "x.stage", "x.decision")


def funnel(videos: DataFrame, results: DataFrame, bands: Bands = DEFAULT_BANDS) -> DataFrame:
    """total, fail, defer, clear over all clips, on the most populated versions."""
    exits = first_exit(versions.most_rows(results), bands)
    every = videos.select("path").join(exits, "path", "left")
    return every.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col("decision") == "bad").alias("fail"),
        F.count_if(F.col("decision") == "unsure").alias("defer"),
        F.count_if(F.col("decision").isNull()).alias("clear"),
    )


def funnel_by_layer(videos: DataFrame, results: DataFrame, bands: Bands = DEFAULT_BANDS) -> DataFrame:
    """stage, exit (FAIL or defer) and clips, for the clips in the catalog."""
    exits = first_exit(versions.most_rows(results), bands).join(videos.select("path"), "path", "left_semi")
    word = F.when(F.col("decision") == "bad", "FAIL").otherwise("defer")
    return exits.groupBy("stage", word.alias("exit")).agg(F.count(F.lit(1)).alias("clips"))


def assemble(results: DataFrame, bands: Bands = DEFAULT_BANDS) -> DataFrame:
    """path, verdict, by: a sure rung fails the clip; else what is unsure goes by the judge; else it passes."""
    any_row = results.filter("stage <> 'verdict'").select("path", "stage", "version", "verdict")
    rows = versions.active(any_row).select("path", "stage", rung().alias("ord"), F.when(F.col("stage") != "vlm", decide(bands)).alias("d"), F.when(F.col("stage") == "vlm", F.coalesce("verdict.verdict", F.lit("PASS"))).alias("judge"))
    per = rows.groupBy("path").agg(
        F.min_by(F.when(F.col("d") == "bad", F.col("stage")), F.when(F.col("d") == "bad", F.col("ord"))).alias("bad_at"),
        F.max(F.coalesce(F.col("d") == "unsure", F.lit(False))).alias("unsure"),
        F.max("judge").alias("judge"),
    )
    # Clips that have rows of other versions only pass, as nothing speaks against them.
    every = any_row.select("path").distinct().join(per, "path", "left")
    by = F.when(F.col("bad_at").isNotNull(), F.col("bad_at")).when(F.col("unsure") & F.col("judge").isNotNull(), "judge").when(F.col("unsure"), "pending-judge").otherwise("auto-clean")
    verdict = F.when(F.col("bad_at").isNotNull(), "FAIL").when(F.col("unsure"), F.coalesce("judge", F.lit("BDLN"))).otherwise("PASS")
    return every.select("path", verdict.alias("verdict"), by.alias("by"))


def suspects(results: DataFrame) -> DataFrame:
    """path, reasons (sorted set over the cheap stages), how (hard, vlm, cleared or pending) and the reasons that count."""
    rows = versions.latest_run(results)
    reasons = F.when(F.size(F.coalesce("verdict.reasons", F.array().cast("array<string>"))) > 0, F.col("verdict.reasons")).otherwise(F.array(F.lit("bad")))
    flagged = rows.filter(F.col("stage").isin(*CHEAP_STAGES) & is_flagged(F.col("verdict"))).select("path", F.explode(reasons).alias("reason"))
    proposed = flagged.groupBy("path").agg(F.array_sort(F.collect_set("reason")).alias("proposed"))
    judge = rows.filter("stage = 'vlm'").select("path", is_flagged(F.col("verdict")).alias("judge_bad"), F.col("verdict.reasons").alias("judge_reasons"))
    both = proposed.join(judge, "path", "left")
    hard = F.arrays_overlap("proposed", F.array(*map(F.lit, HARD)))
    how = F.when(hard, "hard").when(F.col("judge_bad"), "vlm").when(F.col("judge_bad").isNotNull(), "cleared").otherwise("pending")
    own = F.when((how == "vlm") & (F.size(F.coalesce("judge_reasons", F.array().cast("array<string>"))) > 0), F.col("judge_reasons")).otherwise(F.col("proposed"))
    return both.select("path", how.alias("how"), own.alias("reasons"))


def tune_agreement(results: DataFrame, bands: Bands = DEFAULT_BANDS) -> DataFrame:
    """judge_n, decided_judged, agree and agreement (percent) of replayed decisions with the judge's labels."""
    judge = versions.latest_run(results.filter("stage = 'vlm'")).select("path", judge_label(F.col("verdict")).alias("label"))
    exits = first_exit(versions.most_rows(results), bands).select("path", "decision")
    d = F.coalesce("decision", F.lit("good"))
    decided = d.isin("bad", "good")
    out = judge.join(exits, "path", "left").agg(F.count(F.lit(1)).alias("judge_n"), F.count_if(decided).alias("decided_judged"), F.count_if(decided & (d == F.col("label"))).alias("agree"))
    return out.withColumn("agreement", F.when(F.col("decided_judged") > 0, F.floor(1000.0 * F.col("agree") / F.col("decided_judged") + 0.5) / 10.0))
