"""Status, confirm rates, distributions, episode lists and the snapshot."""

from __future__ import annotations

from typing import Any

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bandsieve.functions import bands as B
from bandsieve.functions.stats import histogram, nearest_rank, round_to
from bandsieve.operators import cascade, versions
from bandsieve.schema import ACTIVE_VERSIONS, CHEAP_STAGES, LEVELS, STAGES


def status_matrix(videos: DataFrame, results: DataFrame) -> DataFrame:
    """stage, version, done, pct (whole percent of all clips) and flagged."""
    per = results.groupBy("stage", "version").agg(F.count(F.lit(1)).alias("done"), F.count_if(B.is_flagged(F.col("verdict"))).alias("flagged"))
    total = videos.agg(F.count(F.lit(1)).alias("total"))
    return per.crossJoin(F.broadcast(total)).select("stage", "version", "done", F.floor(100 * F.col("done") / F.greatest("total", F.lit(1))).alias("pct"), "flagged")


def confirm_rate(results: DataFrame) -> DataFrame:
    """Per cheap stage (active version): judged, confirmed and rate of the rows that are bad. The judge's rows are one per clip here."""
    judge = results.filter("stage = 'vlm'").groupBy("path").agg(F.max(B.judge_label(F.col("verdict")) == "bad").alias("confirmed"))
    bad = versions.active(results).filter(F.col("stage").isin(*CHEAP_STAGES) & B.is_bad(F.col("verdict"))).select("path", "stage")
    stages = results.sparkSession.createDataFrame([(s,) for s in CHEAP_STAGES], "stage string")
    have = bad.join(judge, "path").groupBy("stage").agg(F.count(F.lit(1)).alias("judged"), F.count_if("confirmed").alias("confirmed"))
    out = F.broadcast(stages).join(have, "stage", "left").fillna(0, ["judged", "confirmed"])
    return out.withColumn("rate", F.when(F.col("judged") > 0, round_to(F.col("confirmed") / F.col("judged"), 2)))


def panel(videos: DataFrame, results: DataFrame, now: float, snapshot: bool = False) -> DataFrame:
    """One row a rung: done, total, pct, bad, unsure, escal and status at a given time."""
    rows = versions.most_rows(results) if snapshot else versions.active(results)
    decision = F.col("verdict.decision")
    per = rows.groupBy("stage").agg(F.count(F.lit(1)).alias("done"), F.count_if(B.is_bad(F.col("verdict"))).alias("bad"), F.count_if(decision == "unsure").alias("unsure"), F.max("ran_at").alias("last"))
    rungs = results.sparkSession.createDataFrame([(LEVELS[s], s) for s in STAGES], "level string, stage string")
    total = videos.agg(F.count(F.lit(1)).alias("total"))
    out = F.broadcast(rungs).join(per, "stage", "left").fillna(0, ["done", "bad", "unsure"]).crossJoin(F.broadcast(total))
    return out.select("level", "stage", "done", "total", round_to(100.0 * F.col("done") / F.greatest("total", F.lit(1)), 1).alias("pct"), "bad", "unsure", round_to(100.0 * F.col("unsure") / F.greatest("done", F.lit(1)), 1).alias("escal"), status(F.col("last"), F.col("done"), F.col("total"), now, snapshot).alias("status"))


def status(last: Column, done: Column, total: Column, now: float, snapshot: bool = False) -> Column:
    """running (a row in the last 20 seconds), done, idle or waiting."""
    if snapshot:
        return F.lit("done")
    return F.when(F.lit(now) - last < 20, "running").when((done >= total) & (total > 0), "done").when(done > 0, "idle").otherwise("waiting")


def rates(polls: DataFrame) -> DataFrame:
    """Observed rate and remaining seconds between polls (stage, at, done, total)."""
    before = Window.partitionBy("stage").orderBy("at")
    seconds, more = F.col("at") - F.lag("at").over(before), F.col("done") - F.lag("done").over(before)
    rate = F.when((seconds >= 1) & (more > 0), more / seconds).otherwise(0.0)
    return polls.withColumn("rate", rate).withColumn("eta", F.when(F.col("rate") > 0.05, F.floor((F.col("total") - F.col("done")) / F.col("rate") + 0.5)))


def episodes(videos: DataFrame, verdicts: DataFrame, embodiment: str | None = None, verdict: str | None = None, limit: int = 400) -> DataFrame:
    """Clips with verdicts, worst first: a bounded top-k."""
    rows = videos.join(verdicts.select("path", F.coalesce("verdict", F.lit("PASS")).alias("verdict")), "path")
    if embodiment:
        rows = rows.filter(F.col("embodiment") == embodiment)
    if verdict:
        rows = rows.filter(F.col("verdict") == verdict)
    order = F.when(F.col("verdict") == "FAIL", 0).when(F.col("verdict") == "BDLN", 1).when(F.col("verdict") == "PASS", 2).otherwise(3)
    return rows.select("path", "hash", "embodiment", "verdict").orderBy(order, "path").limit(limit)


def hits(results: DataFrame) -> DataFrame:
    """path, tier, reason, t of every hit of the active versions; each verdict's first thirty."""
    rows = versions.active(results)
    return rows.select("path", F.col("stage").alias("tier"), F.explode(F.slice(F.coalesce("verdict.hits", F.array().cast("array<struct<reason:string,t:double,conf:double>>")), 1, 30)).alias("h")).select("path", "tier", "h.reason", "h.t")


def first_hits(results: DataFrame) -> DataFrame:
    """path, reason, t: each reason's earliest hit over the tiers of the active versions."""
    return hits(results).groupBy("path", "reason").agg(F.min("t").alias("t"))


def rubric_rows(results: DataFrame, items: DataFrame) -> DataFrame:
    """path, ord, id, label, passed, first_t: every rubric item of every judged clip, whether the judge passed it (null: it doesn't say)
    and the time of the first hit with the item's id as its reason. A rubric is a file of a few items, broadcast as one row."""
    said = F.filter("verdict.rubric", lambda x: x["id"] == F.col("item.id"))
    judge = versions.active(results).filter("stage = 'vlm'").select("path", "verdict")
    every = items.agg(F.array_sort(F.collect_list(F.struct("ord", "id", "label"))).alias("items"))
    rows = judge.join(F.broadcast(every)).select("path", "verdict", F.explode("items").alias("item"))
    rows = rows.select("path", "item.ord", "item.id", "item.label", F.get(F.transform(said, lambda x: x["pass"]), F.lit(0)).alias("passed"))
    return rows.join(first_hits(results).select("path", F.col("reason").alias("id"), F.col("t").alias("first_t")), ["path", "id"], "left").select("path", "ord", "id", "label", "passed", "first_t")


def snapshot_state(results: DataFrame) -> DataFrame:
    """One row, is_snapshot: cheap_cv has rows, but none of cheap_cv, geometry and objects has any of its active version."""
    own = F.lit(False)
    for s in ("cheap_cv", "geometry", "objects"):
        own = own | (F.col("stage") == s) & (F.col("version") == ACTIVE_VERSIONS[s])
    return results.agg((F.count_if(own) == 0).alias("a"), (F.count_if(F.col("stage") == "cheap_cv") > 0).alias("b")).select((F.col("a") & F.col("b")).alias("is_snapshot"))


def episode(results: DataFrame, path: str, snapshot: bool | None = None, items: DataFrame | None = None) -> dict[str, Any]:
    """One clip in full: its tiers with decisions, in order of rungs, its hits by time, the judge's row, the rubric with first hits, and which tiers
    and versions it has. snapshot None: found out by snapshot_state. A clip without rows has empty lists and verdict PASS."""
    if snapshot is None:
        snapshot = bool(snapshot_state(results).first()["is_snapshot"])
    own = results.filter(F.col("path") == path)
    rows = versions.latest_per_clip(own) if snapshot else versions.active(own)
    tiers = rows.filter(F.col("stage").isin(*STAGES)).withColumn("ord", cascade.rung()).withColumn("decided", F.when(F.col("stage") != "vlm", F.coalesce("verdict.decision", B.decide()))).orderBy("ord").collect()
    found = sorted((dict(tier=r["stage"], reason=h["reason"], t=h["t"]) for r in tiers for h in (r["verdict"]["hits"] or [])), key=lambda h: h["t"])
    judge = next((r["verdict"].asDict(True) for r in tiers if r["stage"] == "vlm"), None)
    final = own.filter("stage = 'verdict'").orderBy(F.desc("ran_at")).select("verdict.verdict").first()
    said = {x["id"]: x["pass"] for x in (judge or {}).get("rubric") or []}
    first: dict[str, float] = {}
    for h in found:
        first.setdefault(h["reason"], h["t"])
    rubric = [x.asDict() | {"passed": said.get(x["id"]), "first_t": first.get(x["id"])} for x in items.orderBy("ord").collect()] if items is not None else []
    return {
        "path": path,
        "verdict": (final["verdict"] if final else None) or "PASS",
        "rungs": [{"level": LEVELS[r["stage"]], "stage": r["stage"], "decision": r["decided"], "verdict": r["verdict"].asDict(True)} for r in tiers],
        "hits": found,
        "judge": judge,
        "rubric": rubric,
        "integrity": {"tiers_run": [r["stage"] for r in tiers], "versions": {r["stage"]: r["version"] for r in tiers}},
    }


def top_reasons(results: DataFrame, n: int = 8) -> DataFrame:
    """stage, reason, count: the n most frequent reasons of each stage's most populated version."""
    counts = versions.most_rows(results).select("stage", F.explode("verdict.reasons").alias("reason")).groupBy("stage", "reason").agg(F.count(F.lit(1)).alias("count"))
    order = Window.partitionBy("stage").orderBy(F.desc("count"), "reason")
    return counts.withColumn("r", F.row_number().over(order)).filter(F.col("r") <= n).drop("r")


def decision_counts(results: DataFrame, bands: B.Bands = B.DEFAULT_BANDS) -> DataFrame:
    """stage, good, unsure, bad: replayed decisions of the most populated versions."""
    rows = versions.most_rows(results).filter(F.col("stage").isin(*CHEAP_STAGES)).withColumn("d", B.decide(bands))
    return rows.groupBy("stage").agg(*[F.count_if(F.col("d") == k).alias(k) for k in ("good", "unsure", "bad")])


def coverage(videos: DataFrame, results: DataFrame) -> DataFrame:
    per = versions.most_rows(results).groupBy("stage").agg(F.count(F.lit(1)).alias("processed"))
    total = videos.agg(F.count(F.lit(1)).alias("total"))
    return per.crossJoin(F.broadcast(total)).select("stage", "processed", round_to(100.0 * F.col("processed") / F.greatest("total", F.lit(1)), 3).alias("coverage_pct"))


def flag_rates(results: DataFrame) -> DataFrame:
    rows = versions.most_rows(results).filter(F.col("stage").isin(*CHEAP_STAGES))
    out = rows.groupBy("stage").agg(F.count(F.lit(1)).alias("n"), F.count_if(B.is_flagged(F.col("verdict"))).alias("flagged"))
    return out.withColumn("rate", round_to(F.col("flagged") / F.greatest("n", F.lit(1)), 4))


def maximum_of(signal: Column) -> Column:
    out = F.when(F.lit(False), F.lit(0.0))
    for k, x in B.SIGNALS.items():
        out = out.when(signal == k, x.maximum)
    return out


def signal_histograms(results: DataFrame, bins: int = 48) -> DataFrame:
    """signal, bin, count."""
    values = B.signals_long(versions.most_rows(results))
    return histogram(values, ["signal"], maximum_of(F.col("signal")), bins, {"count": F.lit(True)})


def judge_histograms(results: DataFrame, bins: int = 40) -> DataFrame:
    """signal, bin, n, judge_bad, judge_good."""
    judge = versions.latest_run(results.filter("stage = 'vlm'")).select("path", B.judge_label(F.col("verdict")).alias("label"))
    values = B.signals_long(versions.most_rows(results)).join(judge, "path", "left")
    return histogram(values, ["signal"], maximum_of(F.col("signal")), bins, {"n": F.lit(True), "judge_bad": F.col("label") == "bad", "judge_good": F.col("label") == "good"})


def regions(histograms: DataFrame, bins: int = 40, bands: B.Bands = B.DEFAULT_BANDS) -> DataFrame:
    """signal, good, unsure, bad: counts by the band of each bin's centre."""
    centre = (F.col("bin") + 0.5) / bins * maximum_of(F.col("signal"))
    decision = F.when(F.lit(False), "good")
    for k in B.SIGNALS:
        decision = decision.when(F.col("signal") == k, B.band(centre, k, bands))
    rows = histograms.withColumn("d", decision)
    return rows.groupBy("signal").agg(*[F.sum(F.when(F.col("d") == k, F.col("n")).otherwise(0)).alias(k) for k in ("good", "unsure", "bad")])


def signal_quantiles(results: DataFrame) -> DataFrame:
    return nearest_rank(B.signals_long(versions.most_rows(results)), ["signal"], {"p10": 0.1, "p50": 0.5, "p90": 0.9})


def survivors(videos: DataFrame, results: DataFrame, bands: B.Bands = B.DEFAULT_BANDS) -> DataFrame:
    """Clips that enter each rung: all less the exits before. The rungs are five rows."""
    exits = cascade.funnel_by_layer(videos, results, bands).groupBy("stage").agg(F.sum("clips").alias("exits"))
    rungs = results.sparkSession.createDataFrame([(i, s) for i, s in enumerate(CHEAP_STAGES)], "ord int, stage string")
    before = Window.orderBy("ord").rowsBetween(Window.unboundedPreceding, -1)
    rows = F.broadcast(rungs).join(exits, "stage", "left").fillna(0, ["exits"]).crossJoin(F.broadcast(videos.agg(F.count(F.lit(1)).alias("total"))))
    return rows.select("ord", "stage", "exits", (F.col("total") - F.coalesce(F.sum("exits").over(before), F.lit(0))).alias("entering"))


def bar_heights(histograms: DataFrame) -> DataFrame:
    """Heights on a log scale, largest bin of a signal 100, at least 1."""
    top = F.greatest(F.max("count").over(Window.partitionBy("signal")), F.lit(1))
    return histograms.select("signal", "bin", round_to(F.greatest(F.lit(1.0), 100 * F.log1p("count") / F.log1p(top)), 2).alias("height"))


def snapshot(videos: DataFrame, results: DataFrame, verdicts: DataFrame, bands: B.Bands = B.DEFAULT_BANDS) -> dict[str, Any]:
    """The public summary as one nested dict; everything collected is one row a stage, signal, bin or verdict."""
    rows = lambda df: [r.asDict(True) for r in df.collect()]
    exits = rows(cascade.funnel_by_layer(videos, results, bands))
    picked = {r["stage"]: r for r in rows(versions.most_rows_versions(results))}
    total = videos.count()
    decisions, reasons = {r["stage"]: r for r in rows(decision_counts(results, bands))}, rows(top_reasons(results))
    stages = []
    for s in CHEAP_STAGES:
        if s in picked:
            stages.append(
                {
                    "id": s,
                    "level": LEVELS[s],
                    "version": picked[s]["version"],
                    "processed": picked[s]["n"],
                    "coverage_pct": round(100 * picked[s]["n"] / max(total, 1), 3),
                    "decisions": {k: decisions[s][k] for k in ("good", "unsure", "bad")},
                    "cascade_exit": {k: sum(e["clips"] for e in exits if e["stage"] == s and e["exit"] == w) for k, w in (("fail", "FAIL"), ("defer", "defer"))},
                    "reasons": sorted(({"reason": r["reason"], "count": r["count"]} for r in reasons if r["stage"] == s), key=lambda r: (-r["count"], r["reason"])),
                }
            )
    judge = versions.most_rows(results.filter("stage = 'vlm'"))
    words = {r["w"]: r["n"] for r in rows(judge.groupBy(F.coalesce("verdict.verdict", F.lit("UNKNOWN")).alias("w")).agg(F.count(F.lit(1)).alias("n")))}
    bins: dict[str, list[int]] = {}
    for r in sorted(rows(signal_histograms(results)), key=lambda r: (r["signal"], r["bin"])):
        bins.setdefault(r["signal"], []).append(r["count"])
    quantiles = {r["signal"]: r for r in rows(signal_quantiles(results))}
    signals = [{"id": k, "stage": x.stage, "maximum": x.maximum, "low_is_bad": x.low_is_bad, "band": list(bands[k]), "samples": sum(bins[k]), "bins": bins[k], "quantiles": {q: quantiles[k][q] for q in ("p10", "p50", "p90")}} for k, x in B.SIGNALS.items() if k in bins]
    count = lambda c: {r[c]: r["n"] for r in rows(verdicts.groupBy(c).agg(F.count(F.lit(1)).alias("n")))}
    return {"total": total, "judge": words, "stages": stages, "signals": signals, "active_threshold_funnel": rows(cascade.funnel(videos, results, bands))[0], "persisted_verdicts": count("verdict"), "persisted_routes": count("by"), "active_versions": dict(ACTIVE_VERSIONS)}
