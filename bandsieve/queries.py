"""Every query of the cascade by name, with the SQL that gives the same rows on the same tables.

The clips are those of plans.corpora: synthetic stand-ins made from events, documents, labels, pages and embeddings."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from bandsieve.functions import bands as B
from bandsieve.functions import text as T
from bandsieve.functions.stats import round_to
from bandsieve.operators import cascade, evaluate, explore, frames, reports, versions
from bandsieve.plans import corpora as C
from bandsieve.schema import CHEAP_STAGES, STAGES
from bandsieve.session import ship
from bandsieve.sources import files
from bandsieve.sources.store import insert_if_absent, upsert_view
from bandsieve.streaming.incremental import throughput

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}

#: Another set of bands, for replays.
STRICT = B.overlay({"black": (0.05, 0.3), "nohand": (0.2, 0.6), "phone": (0.3, 0.5)})
_DECIDE = B.decide_sql()
_ORD = "CASE stage " + " ".join(f"WHEN '{s}' THEN {i}" for i, s in enumerate(STAGES)) + " END"
_CHEAP = "(" + ", ".join(f"'{s}'" for s in CHEAP_STAGES) + ")"
_MOST = "most AS (SELECT stage, version, n FROM (SELECT stage, version, count(*) AS n, row_number() OVER (PARTITION BY stage ORDER BY count(*) DESC, version) AS r FROM results GROUP BY stage, version) WHERE r = 1)"
_LATEST = "latest AS (SELECT stage, version FROM (SELECT stage, version, row_number() OVER (PARTITION BY stage ORDER BY max(ran_at) DESC, version) AS r FROM results GROUP BY stage, version) WHERE r = 1)"
_ACTIVE = "active AS (SELECT * FROM results WHERE version = CASE stage WHEN 'vlm' THEN 'cap' ELSE 'c1' END)"
_MROWS = _MOST + ", mrows AS (SELECT results.* FROM results JOIN most USING (stage, version))"
_LROWS = _LATEST + ", lrows AS (SELECT results.* FROM results JOIN latest USING (stage, version))"
_JUDGE = _LROWS + ", judge AS (SELECT path, CASE WHEN bad OR verdict = 'FAIL' THEN 'bad' ELSE 'good' END AS label, bad, reasons FROM lrows WHERE stage = 'vlm')"
_SIGNAL_CELLS = ", ".join(f"{{'signal': '{k}', 'value': CASE WHEN stage = '{x.stage}' THEN {x.field.split('.')[-1]} END}}" for k, x in B.SIGNALS.items())
_LONG = _MROWS + f", long AS (SELECT path, stage, x.signal AS signal, x.value AS value FROM (SELECT path, stage, unnest([{_SIGNAL_CELLS}]) AS x FROM mrows) WHERE x.value IS NOT NULL)"
_MAX = "CASE signal " + " ".join(f"WHEN '{k}' THEN {x.maximum}::DOUBLE" for k, x in B.SIGNALS.items()) + " END"
_NOT_BAD = "coalesce(decision = 'bad', coalesce(bad, false))"


def _exits(bands: B.Bands = B.DEFAULT_BANDS) -> str:
    return _MROWS + f", exits AS (SELECT path, min_by(stage, o) AS stage, min_by(d, o) AS d FROM (SELECT path, stage, {_ORD} AS o, {B.decide_sql(bands)} AS d FROM mrows WHERE stage IN {_CHEAP}) WHERE d <> 'good' GROUP BY path)"


def _r(x: str, n: int) -> str:
    return f"floor(({x}) * {10**n}.0::DOUBLE + 0.5) / {10**n}.0::DOUBLE"


def query(sql: str | None, prefix: bool = True) -> Callable[[Query], Query]:
    """Registers a query and its SQL; with prefix, the SQL goes on after corpora.PREFIX's table expressions."""

    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = (C.PREFIX.rstrip() + (", " if not sql.lstrip().upper().startswith("SELECT") else "\n") + sql) if prefix else sql
        return f

    return add


# Projections and predicates


@query(f"SELECT path, stage, version, {_DECIDE} AS decision FROM results WHERE stage <> 'vlm'")
def decide_per_stage(spark: SparkSession, d: str) -> DataFrame:
    return C.results_u(spark, d).filter("stage <> 'vlm'").select("path", "stage", "version", B.decide().alias("decision"))


@query(_LONG + " SELECT path, signal, value, CASE " + " ".join(f"WHEN signal = '{k}' THEN {B.band_sql('value', k)}" for k in B.SIGNALS) + " END AS decision FROM long")
def band_each_signal(spark: SparkSession, d: str) -> DataFrame:
    rows = B.signals_long(versions.most_rows(C.results_u(spark, d)))
    decision = F.when(F.lit(False), "good")
    for k in B.SIGNALS:
        decision = decision.when(F.col("signal") == k, B.band(F.col("value"), k))
    return rows.select("path", "signal", "value", decision.alias("decision"))


@query(f"SELECT path, {B.worst_sql(*[f'd_{k}' for k in B.SIGNALS])} AS worst FROM s")
def worst_of(spark: SparkSession, d: str) -> DataFrame:
    f = C.features_u(C.frames_u(spark, d)).filter("user_id % 100 <> 99")
    return f.select("path", B.worst(*[B.band(F.col("motion" if k == "static" else k), k) for k in B.SIGNALS]).alias("worst"))


@query("SELECT DISTINCT path FROM results WHERE stage = 'geometry' AND decision = 'good'")
def gate_good_from(spark: SparkSession, d: str) -> DataFrame:
    return cascade.good_from(C.results_u(spark, d), "geometry")


@query("SELECT DISTINCT path FROM results WHERE stage IN ('cheap_cv', 'geometry', 'objects', 'semantic') AND decision = 'unsure'")
def gate_unsure_any(spark: SparkSession, d: str) -> DataFrame:
    return cascade.unsure_any(C.results_u(spark, d))


@query("SELECT path, stage, version FROM results WHERE coalesce(bad, false)")
def flagged_rows(spark: SparkSession, d: str) -> DataFrame:
    return C.results_u(spark, d).filter(B.is_flagged(F.col("verdict"))).select("path", "stage", "version")


@query(f"SELECT path, stage, version FROM results WHERE {_NOT_BAD}")
def bad_rows(spark: SparkSession, d: str) -> DataFrame:
    return C.results_u(spark, d).filter(B.is_bad(F.col("verdict"))).select("path", "stage", "version")


@query(_JUDGE + " SELECT path, label FROM judge")
def judge_labels(spark: SparkSession, d: str) -> DataFrame:
    return versions.latest_run(C.results_u(spark, d).filter("stage = 'vlm'")).select("path", B.judge_label(F.col("verdict")).alias("label"))


@query("SELECT event_id, CASE WHEN upper(event_type) LIKE 'BORD%' OR upper(event_type) = 'BDLN' THEN 'BDLN' WHEN upper(event_type) = 'FAIL' THEN 'FAIL' ELSE 'PASS' END AS verdict FROM (SELECT event_id, CASE event_type WHEN 'view' THEN 'borderline' WHEN 'error' THEN 'fail' ELSE event_type END AS event_type FROM events)", prefix=False)
def verdict_words(spark: SparkSession, d: str) -> DataFrame:
    e = C.table(spark, d, "events")
    word = F.when(F.col("event_type") == "view", "borderline").when(F.col("event_type") == "error", "fail").otherwise(F.col("event_type"))
    return e.select("event_id", B.normalise_verdict(word).alias("verdict"))


@query("SELECT path, n, list_slice(range(0, n, greatest(1, n // 6)), 1, 6) AS places FROM features")
def keyframe_places(spark: SparkSession, d: str) -> DataFrame:
    f = C.features_u(C.frames_u(spark, d))
    step = F.greatest(F.lit(1).cast("long"), F.floor(F.col("n") / 6))
    return f.select("path", "n", F.slice(F.sequence(F.lit(0).cast("long"), F.col("n") - 1, step), 1, 6).alias("places"))


# Joins


@query("SELECT path FROM videos WHERE path IN (SELECT path FROM results WHERE stage = 'geometry' AND decision = 'good') AND NOT EXISTS (SELECT 1 FROM results r WHERE r.path = videos.path AND stage = 'objects' AND version = 'c2')")
def undone_paths(spark: SparkSession, d: str) -> DataFrame:
    results = C.results_u(spark, d)
    return cascade.undone(C.videos_u(spark, d), results, "objects", "c2", cascade.gate(results, "objects"))


@query("SELECT path FROM videos WHERE path NOT IN (SELECT path FROM results WHERE stage = 'vlm' OR coalesce(bad, false)) ORDER BY md5('0:' || path), path LIMIT 50")
def clean_sample_det(spark: SparkSession, d: str) -> DataFrame:
    return cascade.sample_paths(cascade.clean_candidates(C.videos_u(spark, d), C.results_u(spark, d)), 50)


_ASSEMBLE = _ACTIVE + f", dec AS (SELECT path, stage, {_ORD} AS o, CASE WHEN stage <> 'vlm' THEN {_DECIDE} END AS d, CASE WHEN stage = 'vlm' THEN coalesce(verdict, 'PASS') END AS judge FROM active), per AS (SELECT path, min_by(stage, o) FILTER (d = 'bad') AS bad_at, coalesce(bool_or(d = 'unsure'), false) AS unsure, max(judge) AS judge FROM dec GROUP BY path), final AS (SELECT path, CASE WHEN bad_at IS NOT NULL THEN 'FAIL' WHEN unsure THEN coalesce(judge, 'BDLN') ELSE 'PASS' END AS verdict, CASE WHEN bad_at IS NOT NULL THEN bad_at WHEN unsure AND judge IS NOT NULL THEN 'judge' WHEN unsure THEN 'pending-judge' ELSE 'auto-clean' END AS \"by\" FROM (SELECT DISTINCT path FROM results) LEFT JOIN per USING (path))"


@query(_ASSEMBLE + ' SELECT path, verdict, "by" FROM final')
def verdict_per_clip(spark: SparkSession, d: str) -> DataFrame:
    return cascade.assemble(C.results_u(spark, d))


@query(_ASSEMBLE + " SELECT verdict, count(*) AS clips FROM final GROUP BY verdict")
def verdict_distribution(spark: SparkSession, d: str) -> DataFrame:
    return cascade.assemble(C.results_u(spark, d)).groupBy("verdict").agg(F.count(F.lit(1)).alias("clips"))


@query(_ASSEMBLE + ' SELECT "by", count(*) AS clips FROM final GROUP BY "by"')
def route_distribution(spark: SparkSession, d: str) -> DataFrame:
    return cascade.assemble(C.results_u(spark, d)).groupBy("by").agg(F.count(F.lit(1)).alias("clips"))


@query(_ASSEMBLE + " SELECT path, hash, embodiment, verdict FROM videos JOIN final USING (path) ORDER BY CASE verdict WHEN 'FAIL' THEN 0 WHEN 'BDLN' THEN 1 WHEN 'PASS' THEN 2 ELSE 3 END, path LIMIT 400")
def episodes_list(spark: SparkSession, d: str) -> DataFrame:
    return reports.episodes(C.videos_u(spark, d), cascade.assemble(C.results_u(spark, d)))


@query(_ASSEMBLE + " SELECT path, hash, embodiment, verdict FROM videos JOIN final USING (path) WHERE embodiment = '1' AND verdict = 'BDLN' ORDER BY path LIMIT 400")
def episodes_filtered(spark: SparkSession, d: str) -> DataFrame:
    return reports.episodes(C.videos_u(spark, d), cascade.assemble(C.results_u(spark, d)), "1", "BDLN")


_HITS = ", ".join(f"struct_pack(tier := '{x.stage}', reason := '{ {'nohand': 'missing_hands'}.get(k, k) }', d := d_{k})" for k, x in B.SIGNALS.items())


@query(f"SELECT path, h.tier AS tier, h.reason AS reason, 0.0::DOUBLE AS t FROM (SELECT path, user_id, unnest([{_HITS}]) AS h FROM s) WHERE h.d <> 'good' AND NOT (h.tier = 'semantic' AND user_id % 97 = 0)")
def episode_hits(spark: SparkSession, d: str) -> DataFrame:
    return reports.hits(C.results_u(spark, d))


@query("SELECT DISTINCT embodiment FROM videos")
def embodiments(spark: SparkSession, d: str) -> DataFrame:
    return C.videos_u(spark, d).select("embodiment").distinct()


# Funnels and replays


@query(_exits() + " SELECT count(*) AS total, count(*) FILTER (d = 'bad') AS fail, count(*) FILTER (d = 'unsure') AS defer, count(*) FILTER (d IS NULL) AS clear FROM videos LEFT JOIN exits USING (path)")
def funnel_totals(spark: SparkSession, d: str) -> DataFrame:
    return cascade.funnel(C.videos_u(spark, d), C.results_u(spark, d))


@query(_exits() + " SELECT stage, CASE d WHEN 'bad' THEN 'FAIL' ELSE 'defer' END AS exit, count(*) AS clips FROM exits GROUP BY ALL")
def funnel_by_layer(spark: SparkSession, d: str) -> DataFrame:
    return cascade.funnel_by_layer(C.videos_u(spark, d), C.results_u(spark, d))


@query(_exits(STRICT) + " SELECT count(*) AS total, count(*) FILTER (d = 'bad') AS fail, count(*) FILTER (d = 'unsure') AS defer, count(*) FILTER (d IS NULL) AS clear FROM videos LEFT JOIN exits USING (path)")
def funnel_custom_bands(spark: SparkSession, d: str) -> DataFrame:
    return cascade.funnel(C.videos_u(spark, d), C.results_u(spark, d), STRICT)


@query("SELECT sum((black > 0.5 OR blur > 0.9 OR motion < 0.002)::BIGINT)::BIGINT AS bad, sum((NOT (black > 0.5 OR blur > 0.9 OR motion < 0.002) AND NOT (black < 0.1 AND blur < 0.5 AND motion > 0.01))::BIGINT)::BIGINT AS unsure, sum((black < 0.1 AND blur < 0.5 AND motion > 0.01)::BIGINT)::BIGINT AS good FROM (SELECT doc_id, avg(CASE WHEN luma < 16 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) AS black, avg(CASE WHEN luma < 100 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) AS blur, coalesce(median(abs(luma - before) / 255::DOUBLE), 1.0::DOUBLE) AS motion FROM (SELECT doc_id, luma, lag(luma) OVER (PARTITION BY doc_id ORDER BY i) AS before FROM (SELECT doc_id, length(line) AS luma, i FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM documents))) GROUP BY doc_id)", prefix=False)
def document_lines_layer(spark: SparkSession, d: str) -> DataFrame:
    f = C.frames_d(spark, d)
    scores = frames.blocked_and_still(f.select("path", "luma", F.col("luma").alias("sharpness"), (F.abs(F.col("luma") - F.col("before")) / 255).alias("motion")))
    decision = B.worst(B.band(F.col("black_frac"), "black"), B.band(F.col("blur_frac"), "blur"), B.band(F.col("med_motion"), "static"))
    return scores.select(decision.alias("d")).agg(*[F.count_if(F.col("d") == k).alias(k) for k in ("bad", "unsure", "good")])


@query(_exits() + ", " + _LROWS + ", judge AS (SELECT path, CASE WHEN bad OR verdict = 'FAIL' THEN 'bad' ELSE 'good' END AS label FROM lrows WHERE stage = 'vlm'), a AS (SELECT label, coalesce(d, 'good') AS d FROM judge LEFT JOIN exits USING (path)) SELECT count(*) AS judge_n, count(*) FILTER (d <> 'unsure') AS decided_judged, count(*) FILTER (d = label) AS agree, CASE WHEN count(*) FILTER (d <> 'unsure') > 0 THEN floor(1000.0::DOUBLE * count(*) FILTER (d = label) / count(*) FILTER (d <> 'unsure') + 0.5) / 10.0::DOUBLE END AS agreement FROM a")
def tune_agreement(spark: SparkSession, d: str) -> DataFrame:
    return cascade.tune_agreement(C.results_u(spark, d))


@query(_exits(STRICT) + ", " + _LROWS + ", judge AS (SELECT path, CASE WHEN bad OR verdict = 'FAIL' THEN 'bad' ELSE 'good' END AS label FROM lrows WHERE stage = 'vlm'), a AS (SELECT label, coalesce(d, 'good') AS d FROM judge LEFT JOIN exits USING (path)) SELECT count(*) AS judge_n, count(*) FILTER (d <> 'unsure') AS decided_judged, count(*) FILTER (d = label) AS agree, CASE WHEN count(*) FILTER (d <> 'unsure') > 0 THEN floor(1000.0::DOUBLE * count(*) FILTER (d = label) / count(*) FILTER (d <> 'unsure') + 0.5) / 10.0::DOUBLE END AS agreement FROM a")
def tune_agreement_custom(spark: SparkSession, d: str) -> DataFrame:
    return cascade.tune_agreement(C.results_u(spark, d), STRICT)


@query(_exits() + " , e AS (SELECT stage, count(*) AS exits FROM exits GROUP BY stage), g AS (SELECT o::INT AS ord, stage, coalesce(exits, 0) AS exits FROM (SELECT unnest(['meta', 'cheap_cv', 'geometry', 'objects', 'semantic']) AS stage, unnest([0, 1, 2, 3, 4]) AS o) LEFT JOIN e USING (stage)) SELECT ord, stage, exits, ((SELECT count(*) FROM videos) - coalesce(sum(exits) OVER (ORDER BY ord ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::BIGINT AS entering FROM g")
def survivors_by_rung(spark: SparkSession, d: str) -> DataFrame:
    return reports.survivors(C.videos_u(spark, d), C.results_u(spark, d))


# Versions and the store


@query(_MOST + " SELECT stage, version, n FROM most")
def version_most_rows(spark: SparkSession, d: str) -> DataFrame:
    return versions.most_rows_versions(C.results_u(spark, d))


@query(_LATEST + " SELECT stage, version FROM latest")
def version_latest_run(spark: SparkSession, d: str) -> DataFrame:
    return versions.latest_run_versions(C.results_u(spark, d))


@query(_ACTIVE + " SELECT path, stage, version FROM active")
def version_active(spark: SparkSession, d: str) -> DataFrame:
    return versions.active(C.results_u(spark, d)).select("path", "stage", "version")


@query("SELECT path, stage, version, ran_at FROM (SELECT *, row_number() OVER (PARTITION BY path, stage ORDER BY ran_at DESC, version) AS r FROM results) WHERE r = 1")
def latest_per_clip(spark: SparkSession, d: str) -> DataFrame:
    return versions.latest_per_clip(C.results_u(spark, d)).select("path", "stage", "version", "ran_at")


@query("SELECT user_id, event_type, event_id, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id DESC) AS r FROM events) WHERE r = 1", prefix=False)
def upsert_latest(spark: SparkSession, d: str) -> DataFrame:
    rows = C.table(spark, d, "events").select("user_id", "event_type", "event_id", "value")
    return upsert_view(rows, ("user_id", "event_type"), "event_id")


@query("SELECT DISTINCT user_id FROM events WHERE event_type = 'view' AND user_id NOT IN (SELECT user_id FROM events WHERE event_type = 'error')", prefix=False)
def insert_absent(spark: SparkSession, d: str) -> DataFrame:
    e = C.table(spark, d, "events")
    old, new = (e.filter(F.col("event_type") == k).select("user_id") for k in ("error", "view"))
    return insert_if_absent(old, new, ["user_id"])


# Reports


@query("SELECT stage, version, count(*) AS done, floor(100 * count(*) / greatest((SELECT count(*) FROM videos), 1))::BIGINT AS pct, count(*) FILTER (coalesce(bad, false)) AS flagged FROM results GROUP BY stage, version")
def status_matrix(spark: SparkSession, d: str) -> DataFrame:
    return reports.status_matrix(C.videos_u(spark, d), C.results_u(spark, d))


@query(_ACTIVE + f", j AS (SELECT path, bool_or(bad OR verdict = 'FAIL') AS yes FROM results WHERE stage = 'vlm' GROUP BY path), b AS (SELECT stage, count(*) AS judged, count(*) FILTER (yes) AS confirmed FROM active JOIN j USING (path) WHERE stage IN {_CHEAP} AND {_NOT_BAD} GROUP BY stage) SELECT stage, coalesce(judged, 0) AS judged, coalesce(confirmed, 0) AS confirmed, CASE WHEN judged > 0 THEN {_r('confirmed / judged', 2)} END AS rate FROM (SELECT unnest(['meta', 'cheap_cv', 'geometry', 'objects', 'semantic']) AS stage) LEFT JOIN b USING (stage)")
def stage_confirm_rate(spark: SparkSession, d: str) -> DataFrame:
    return reports.confirm_rate(C.results_u(spark, d))


_NOW = 1.8e9


@query(_ACTIVE + f", p AS (SELECT stage, count(*) AS done, count(*) FILTER ({_NOT_BAD}) AS bad, count(*) FILTER (decision = 'unsure') AS unsure, max(ran_at) AS last FROM active GROUP BY stage), v AS (SELECT count(*) AS total FROM videos) SELECT level, stage, coalesce(done, 0) AS done, total, {_r('100.0::DOUBLE * coalesce(done, 0) / greatest(total, 1)', 1)} AS pct, coalesce(bad, 0) AS bad, coalesce(unsure, 0) AS unsure, {_r('100.0::DOUBLE * coalesce(unsure, 0) / greatest(coalesce(done, 0), 1)', 1)} AS escal, CASE WHEN {_NOW} - last < 20 THEN 'running' WHEN coalesce(done, 0) >= total AND total > 0 THEN 'done' WHEN coalesce(done, 0) > 0 THEN 'idle' ELSE 'waiting' END AS status FROM (SELECT unnest(['L0', 'L1', 'L2', 'L3', 'L3', 'L4']) AS level, unnest(['meta', 'cheap_cv', 'geometry', 'objects', 'semantic', 'vlm']) AS stage) LEFT JOIN p USING (stage), v")
def rung_panel(spark: SparkSession, d: str) -> DataFrame:
    return reports.panel(C.videos_u(spark, d), C.results_u(spark, d), _NOW)


@query(_MROWS + ", c AS (SELECT stage, reason, count(*) AS count FROM (SELECT stage, unnest(reasons) AS reason FROM mrows) GROUP BY ALL) SELECT stage, reason, count FROM (SELECT *, row_number() OVER (PARTITION BY stage ORDER BY count DESC, reason) AS r FROM c) WHERE r <= 8")
def reasons_top8(spark: SparkSession, d: str) -> DataFrame:
    return reports.top_reasons(C.results_u(spark, d))


@query(_MROWS + f", q AS (SELECT stage, {_DECIDE} AS d FROM mrows WHERE stage IN {_CHEAP}) SELECT stage, count(*) FILTER (d = 'good') AS good, count(*) FILTER (d = 'unsure') AS unsure, count(*) FILTER (d = 'bad') AS bad FROM q GROUP BY stage")
def decision_counts(spark: SparkSession, d: str) -> DataFrame:
    return reports.decision_counts(C.results_u(spark, d))


@query(_MROWS + f" SELECT stage, count(*) AS processed, {_r('100.0::DOUBLE * count(*) / greatest((SELECT count(*) FROM videos), 1)', 3)} AS coverage_pct FROM mrows GROUP BY stage")
def coverage(spark: SparkSession, d: str) -> DataFrame:
    return reports.coverage(C.videos_u(spark, d), C.results_u(spark, d))


@query(_MROWS + f" SELECT stage, count(*) AS n, count(*) FILTER (coalesce(bad, false)) AS flagged, {_r('count(*) FILTER (coalesce(bad, false)) / count(*)', 4)} AS rate FROM mrows WHERE stage IN {_CHEAP} GROUP BY stage")
def flag_rates(spark: SparkSession, d: str) -> DataFrame:
    return reports.flag_rates(C.results_u(spark, d))


_SUSPECTS = _LROWS + f", flagged AS (SELECT path, unnest(CASE WHEN len(reasons) > 0 THEN reasons ELSE ['bad'] END) AS reason FROM lrows WHERE stage IN {_CHEAP} AND coalesce(bad, false)), proposed AS (SELECT path, list_sort(list_distinct(list(reason))) AS proposed FROM flagged GROUP BY path), jj AS (SELECT path, bad AS jb, reasons AS jr FROM lrows WHERE stage = 'vlm'), sus AS (SELECT path, how, CASE WHEN how = 'vlm' AND len(jr) > 0 THEN jr ELSE proposed END AS reasons FROM (SELECT *, CASE WHEN list_has_any(proposed, ['black', 'empty', 'corrupt', 'probe_fail', 'decode_fail', 'error']) THEN 'hard' WHEN jb THEN 'vlm' WHEN jb IS NOT NULL THEN 'cleared' ELSE 'pending' END AS how FROM proposed LEFT JOIN jj USING (path)))"


@query(_SUSPECTS + " SELECT path, how, array_to_string(reasons, ',') AS reasons FROM sus")
def bad_list(spark: SparkSession, d: str) -> DataFrame:
    return cascade.suspects(C.results_u(spark, d)).select("path", "how", F.array_join("reasons", ",").alias("reasons"))


@query(_SUSPECTS + " SELECT reason, count(*) AS clips FROM (SELECT unnest(reasons) AS reason FROM sus WHERE how IN ('hard', 'vlm')) GROUP BY reason")
def bad_by_reason(spark: SparkSession, d: str) -> DataFrame:
    confirmed = cascade.suspects(C.results_u(spark, d)).filter(F.col("how").isin("hard", "vlm"))
    return confirmed.select(F.explode("reasons").alias("reason")).groupBy("reason").agg(F.count(F.lit(1)).alias("clips"))


@query(_SUSPECTS + " SELECT path, how, len(reasons)::INT AS n FROM sus WHERE how IN ('hard', 'vlm') ORDER BY len(reasons) DESC, path LIMIT 100")
def bad_most_reasons(spark: SparkSession, d: str) -> DataFrame:
    rows = cascade.suspects(C.results_u(spark, d)).filter(F.col("how").isin("hard", "vlm"))
    return rows.select("path", "how", F.size("reasons").alias("n")).orderBy(F.desc("n"), "path").limit(100)


# Distributions


def _hist_sql(bins: int) -> str:
    b = f"least({bins - 1}, greatest(0, floor(value / ({_MAX}) * {bins})))::INT"
    return _LONG + f", have AS (SELECT signal, {b} AS bin, path, value FROM long WHERE NOT isnan(value) AND abs(value) < 'inf'::DOUBLE), every AS (SELECT signal, unnest(range(0, {bins}))::INT AS bin FROM (SELECT DISTINCT signal FROM long))"


@query(_hist_sql(48) + " SELECT signal, bin, count(path) AS count FROM every LEFT JOIN have USING (signal, bin) GROUP BY ALL")
def hist48(spark: SparkSession, d: str) -> DataFrame:
    return reports.signal_histograms(C.results_u(spark, d))


_H40 = _hist_sql(40) + ", " + _JUDGE + ", h40 AS (SELECT signal, bin, count(have.path) AS n, count(*) FILTER (label = 'bad') AS judge_bad, count(*) FILTER (label = 'good') AS judge_good FROM every LEFT JOIN have USING (signal, bin) LEFT JOIN judge ON judge.path = have.path GROUP BY ALL)"


@query(_H40 + " SELECT signal, bin, n, judge_bad, judge_good FROM h40")
def hist40_judge(spark: SparkSession, d: str) -> DataFrame:
    return reports.judge_histograms(C.results_u(spark, d))


_CENTRE = f"((bin + 0.5::DOUBLE) / 40 * ({_MAX}))"
_REGION = "CASE " + " ".join(f"WHEN signal = '{k}' THEN {B.band_sql(_CENTRE, k)}" for k in B.SIGNALS) + " END"


@query(_H40 + f", z AS (SELECT signal, n, {_REGION} AS d FROM h40) SELECT signal, sum(CASE WHEN d = 'good' THEN n ELSE 0 END)::BIGINT AS good, sum(CASE WHEN d = 'unsure' THEN n ELSE 0 END)::BIGINT AS unsure, sum(CASE WHEN d = 'bad' THEN n ELSE 0 END)::BIGINT AS bad FROM z GROUP BY signal")
def region_from_bins(spark: SparkSession, d: str) -> DataFrame:
    return reports.regions(reports.judge_histograms(C.results_u(spark, d)))


@query(_hist_sql(48) + f", h AS (SELECT signal, bin, count(path) AS n FROM every LEFT JOIN have USING (signal, bin) GROUP BY ALL) SELECT signal, bin, {_r('greatest(1.0::DOUBLE, 100 * ln(1 + n::DOUBLE) / ln(1 + greatest(max(n) OVER (PARTITION BY signal), 1)::DOUBLE))', 2)} AS height FROM h")
def log_bar_scale(spark: SparkSession, d: str) -> DataFrame:
    return reports.bar_heights(reports.signal_histograms(C.results_u(spark, d)))


def _rank_sql(f: float) -> str:
    return _r(f"list_sort(list(value))[1 + round_even((count(*) - 1) * {f}::DOUBLE, 0)::BIGINT]", 6)


@query(_LONG + f" SELECT signal, {_rank_sql(0.1)} AS p10, {_rank_sql(0.5)} AS p50, {_rank_sql(0.9)} AS p90 FROM long GROUP BY signal")
def quantiles_nearest(spark: SparkSession, d: str) -> DataFrame:
    return reports.signal_quantiles(C.results_u(spark, d))


# Evaluation: documents are clips, labels are the gold set


def _gold(spark: SparkSession, d: str) -> DataFrame:
    labels = C.table(spark, d, "labels")
    reasons = F.filter(F.array(F.when(F.col("quality") == 0, "blur"), F.when(F.col("toxic") == 1, "phone")), lambda x: x.isNotNull())
    return labels.select(F.col("doc_id").cast("string").alias("video"), reasons.alias("reasons"))


def _lines(spark: SparkSession, d: str, version: int) -> DataFrame:
    """Rows of the line layer in two versions: path and verdict.reasons."""
    f = C.frames_d(spark, d)
    s = frames.blocked_and_still(f.select(F.col("path").cast("string").alias("path"), "luma", F.col("luma").alias("sharpness"), (F.abs(F.col("luma") - F.col("before")) / 255).alias("motion")))
    cut = 0.5 if version == 1 else 0.9
    reasons = F.filter(F.array(F.when(F.col("blur_frac") > cut, "blur"), F.when(F.col("black_frac") > 0.1, "black"), F.when(F.col("med_motion") < 0.05, "phone")), lambda x: x.isNotNull())
    return s.select("path", F.struct(reasons.alias("reasons")).alias("verdict"))


def _lines_sql(version: int) -> str:
    cut = 0.5 if version == 1 else 0.9
    return f"SELECT doc_id, list_filter([CASE WHEN blur > {cut} THEN 'blur' END, CASE WHEN black > 0.1 THEN 'black' END, CASE WHEN motion < 0.05 THEN 'phone' END], lambda x: x IS NOT NULL) AS predicted FROM lines"


_LINES = "lines AS (SELECT doc_id, avg(CASE WHEN luma < 16 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) AS black, avg(CASE WHEN luma < 100 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) AS blur, coalesce(median(abs(luma - before) / 255::DOUBLE), 1.0::DOUBLE) AS motion FROM (SELECT doc_id, luma, lag(luma) OVER (PARTITION BY doc_id ORDER BY i) AS before FROM (SELECT doc_id, length(line) AS luma, i FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM documents))) GROUP BY doc_id)"
_GOLD = "gold AS (SELECT doc_id, list_filter([CASE WHEN quality = 0 THEN 'blur' END, CASE WHEN toxic = 1 THEN 'phone' END], lambda x: x IS NOT NULL) AS actual FROM labels)"


def _prf_sql(source: str, name: str) -> str:
    p, r = "CASE WHEN np > 0 THEN tp / np WHEN na = 0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END", "CASE WHEN na > 0 THEN tp / na ELSE 1.0::DOUBLE END"
    return f"b_{name} AS (SELECT doc_id, actual, predicted FROM gold JOIN ({source}) USING (doc_id)), c_{name} AS (SELECT category, sum((a AND p)::INT) AS tp, sum(p::INT) AS np, sum(a::INT) AS na FROM (SELECT list_contains(actual, category) AS a, list_contains(predicted, category) AS p, category FROM b_{name}, (SELECT unnest(['black', 'blur', 'phone']) AS category)) GROUP BY category HAVING bool_or(a OR p)), {name} AS (SELECT category, {_r('p', 3)} AS precision, {_r('r', 3)} AS recall, {_r('CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0.0::DOUBLE END', 3)} AS f1, na::BIGINT AS n_gold FROM (SELECT *, {p} AS p, {r} AS r FROM c_{name}))"


@query(f"WITH {_LINES}, {_GOLD}, {_prf_sql(_lines_sql(1), 'v1')} SELECT category, precision, recall, f1, n_gold FROM v1", prefix=False)
def prf_by_category(spark: SparkSession, d: str) -> DataFrame:
    return evaluate.score_against_gold(_lines(spark, d, 1), _gold(spark, d))


@query(f"WITH {_LINES}, {_GOLD}, {_prf_sql(_lines_sql(1), 'v1')}, {_prf_sql(_lines_sql(2), 'v2')} SELECT 'v1' AS version, category, precision, recall, f1 FROM v1 UNION ALL SELECT 'v2', category, precision, recall, f1 FROM v2", prefix=False)
def version_compare(spark: SparkSession, d: str) -> DataFrame:
    gold = _gold(spark, d)
    one = lambda v: evaluate.score_against_gold(_lines(spark, d, v), gold).withColumns({"stage": F.lit("cheap_cv"), "version": F.lit(f"v{v}"), "ran_at": F.lit(float(v))})
    old = one(2).withColumns({"version": F.lit("v1"), "ran_at": F.lit(0.0)})
    return evaluate.compare(one(1).unionByName(one(2)).unionByName(old), "cheap_cv")


@query(_JUDGE + f", fl AS (SELECT path, stage, version, unnest(list_concat(['_overall'], reasons)) AS category FROM results WHERE stage IN {_CHEAP} AND coalesce(bad, false)) SELECT stage, version, category, {_r('avg(judge.bad::INT::DOUBLE)', 3)} AS precision, count(*) AS n_gold FROM fl JOIN judge USING (path) GROUP BY ALL")
def confirm_by_reason(spark: SparkSession, d: str) -> DataFrame:
    return evaluate.confirm(C.results_u(spark, d))


# Frames


@query("SELECT path, n, round(black, 6) AS black, round(blur, 6) AS blur, round(motion, 6) AS motion, round(phone, 6) AS phone FROM features")
def frame_features(spark: SparkSession, d: str) -> DataFrame:
    return C.features_u(C.frames_u(spark, d)).select("path", "n", *[F.round(c, 6).alias(c) for c in ("black", "blur", "motion", "phone")])


@query("SELECT doc_id AS path, i::INT AS i, round(abs(luma - lag(luma) OVER (PARTITION BY doc_id ORDER BY i)) / 255::DOUBLE, 6) AS motion FROM (SELECT doc_id, length(line) AS luma, i - 1 AS i FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM documents))", prefix=False)
def frame_motion(spark: SparkSession, d: str) -> DataFrame:
    return frames.motion(C.frames_d(spark, d).select("path", "i", "luma")).select("path", "i", F.round("motion", 6).alias("motion"))


@query("SELECT path, grp AS \"group\", round(count(*) / sum(count(*)) OVER (PARTITION BY path)::DOUBLE, 6) AS frac FROM (SELECT path, i, first(g ORDER BY sim DESC, g) AS grp FROM (SELECT path, i, unnest(['away', 'none', 'work']) AS g, unnest([(value * 7) % 5, (value * 3) % 5, (value * 11) % 5]) AS sim FROM (SELECT path, i, floor(value) AS value FROM frames)) GROUP BY path, i) GROUP BY path, grp")
def group_fractions(spark: SparkSession, d: str) -> DataFrame:
    v = F.floor("value")
    cells = F.array(*[F.struct(F.lit(g).alias("group"), (v * k % 5).cast("double").alias("sim")) for g, k in (("away", 7), ("none", 3), ("work", 11))])
    scores = C.frames_u(spark, d).select("path", "i", F.explode(cells).alias("x")).select("path", "i", "x.*")
    return frames.winning_groups(scores).select("path", "group", F.round("frac", 6).alias("frac"))


@query("SELECT label, d::INT AS d, round(avg(x), 6) AS x FROM (SELECT label, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) - 1 AS d FROM embeddings) GROUP BY ALL", prefix=False)
def mean_pool(spark: SparkSession, d: str) -> DataFrame:
    pooled = frames.mean_pool(C.table(spark, d, "embeddings"), "label", "embedding")
    return pooled.select("label", F.posexplode("pooled").alias("d", "x")).select("label", "d", F.round("x", 6).alias("x"))


# Embedding space

_SIM = "WITH RECURSIVE e AS MATERIALIZED (SELECT vec_id AS id, embedding::DOUBLE[] AS v FROM embeddings), u AS MATERIALIZED (SELECT id, v, sqrt(list_dot_product(v, v)) + 1e-8 AS n FROM e), p AS MATERIALIZED (SELECT a.id AS id, b.id AS neighbour, list_dot_product(a.v, b.v) / a.n / b.n AS sim FROM u a, u b WHERE a.id <> b.id), k AS MATERIALIZED (SELECT id, neighbour, sim, r AS rank FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY sim DESC, neighbour) AS r FROM p) WHERE r <= 10)"
DUP = 0.45


def _found(spark: SparkSession, d: str) -> DataFrame:
    return explore.neighbours(C.table(ship(spark), d, "embeddings"))


@query(_SIM + " SELECT id, neighbour, round(sim, 6) AS sim FROM k WHERE rank = 1", prefix=False)
def nn_top1(spark: SparkSession, d: str) -> DataFrame:
    return explore.nearest(_found(spark, d)).withColumn("sim", F.round("sim", 6))


@query(_SIM + " SELECT id, round(avg(sim), 6) AS mean_sim FROM k GROUP BY id", prefix=False)
def nn_topk_mean(spark: SparkSession, d: str) -> DataFrame:
    return explore.topk_mean(_found(spark, d)).withColumn("mean_sim", F.round("mean_sim", 6))


@query(_SIM + f" SELECT id, neighbour, round(sim, 6) AS sim FROM k WHERE rank = 1 AND sim >= {DUP}", prefix=False)
def dup_pairs(spark: SparkSession, d: str) -> DataFrame:
    return explore.dup_pairs(_found(spark, d), DUP).withColumn("sim", F.round("sim", 6))


@query(_SIM + " SELECT id, neighbour FROM k WHERE rank = 1 AND sim >= 0.95", prefix=False)
def dup_pairs_strict(spark: SparkSession, d: str) -> DataFrame:
    return explore.dup_pairs(_found(spark, d), 0.95).select("id", "neighbour")


@query(_SIM + f" SELECT count(*) FILTER (sim >= {DUP}) AS dups, {_r(f'avg((sim >= {DUP})::INT::DOUBLE)', 4)} AS rate FROM k WHERE rank = 1", prefix=False)
def dup_rate(spark: SparkSession, d: str) -> DataFrame:
    is_dup = F.col("sim") >= DUP
    return explore.nearest(_found(spark, d)).agg(F.count_if(is_dup).alias("dups"), round_to(F.avg(is_dup.cast("int").cast("double")), 4).alias("rate"))


@query(_SIM + f" SELECT id, {_r('1 - avg(sim)', 4)} AS isolation FROM k GROUP BY id ORDER BY avg(sim), id LIMIT 20", prefix=False)
def outliers(spark: SparkSession, d: str) -> DataFrame:
    return explore.outliers(_found(spark, d), 20)


_COMP = _SIM + f", g AS MATERIALIZED (SELECT id AS a, neighbour AS b FROM k WHERE rank = 1 AND sim >= {DUP}), h AS (SELECT a, b FROM g UNION SELECT b, a FROM g), w AS (SELECT a AS node, a AS root FROM h UNION SELECT h.b, w.root FROM w JOIN h ON h.a = w.node), comp AS (SELECT node AS id, min(root) AS component FROM w GROUP BY node)"


@query(_COMP + " SELECT id, component FROM comp", prefix=False)
def dup_components(spark: SparkSession, d: str) -> DataFrame:
    return explore.components(explore.dup_pairs(_found(spark, d), DUP).select(F.col("id").alias("a"), F.col("neighbour").alias("b")))


@query(_COMP + " SELECT component, count(*) AS size, array_to_string(list_slice(list_sort(list(id)), 1, 6), ',') AS examples FROM comp GROUP BY component ORDER BY size DESC, component LIMIT 10", prefix=False)
def dup_clusters(spark: SparkSession, d: str) -> DataFrame:
    groups = explore.clusters(explore.dup_pairs(_found(spark, d), DUP).select(F.col("id").alias("a"), F.col("neighbour").alias("b")))
    return groups.orderBy(F.desc("size"), "component").limit(10).withColumn("examples", F.array_join("examples", ","))


# Listings, rates, streams


@query("SELECT split_part(regexp_replace(url, '^https?://', ''), '/', 1) AS prefix, count(*) AS objects, sum(length(html))::BIGINT AS bytes FROM pages GROUP BY ALL", prefix=False)
def prefix_sizes(spark: SparkSession, d: str) -> DataFrame:
    listed = C.table(spark, d, "pages").select(F.regexp_replace("url", "^https?://", "").alias("key"), F.length("html").cast("long").alias("size"))
    return files.prefix_sizes(listed)


@query("SELECT key FROM (SELECT url AS key FROM pages) WHERE key NOT IN (SELECT url FROM pages WHERE page_id % 3 = 0)", prefix=False)
def missing_objects(spark: SparkSession, d: str) -> DataFrame:
    listed = C.table(spark, d, "pages").select(F.col("url").alias("key"), F.length("html").cast("long").alias("size"), "page_id")
    return files.missing_objects(listed.select("key"), listed.filter("page_id % 3 = 0").select("key", "size"))


_POLLS = "polls AS (SELECT event_type AS stage, floor(epoch_us(ts) / 1e6 / 3600) * 3600 AS \"at\", count(*) AS c FROM events GROUP BY ALL), done AS (SELECT stage, \"at\", sum(c) OVER (PARTITION BY stage ORDER BY \"at\")::BIGINT AS done, (SELECT count(*) FROM events) AS total FROM polls), lagged AS (SELECT *, \"at\" - lag(\"at\") OVER w AS s, done - lag(done) OVER w AS m FROM done WINDOW w AS (PARTITION BY stage ORDER BY \"at\")), rated AS (SELECT *, CASE WHEN s >= 1 AND m > 0 THEN m / s ELSE 0.0::DOUBLE END AS rate0 FROM lagged)"


@query(f"WITH {_POLLS} SELECT stage, \"at\", done, round(rate0, 9) AS rate, CASE WHEN rate0 > 0.05 THEN floor((total - done) / rate0 + 0.5)::BIGINT END AS eta FROM rated", prefix=False)
def rate_eta(spark: SparkSession, d: str) -> DataFrame:
    e = C.table(spark, d, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    at = F.floor(F.unix_micros("ts") / 1e6 / 3600) * 3600.0
    polls = e.groupBy(F.col("event_type").alias("stage"), at.alias("at")).agg(F.count(F.lit(1)).alias("c"))
    running = Window.partitionBy("stage").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    total = e.agg(F.count(F.lit(1)).alias("total"))
    rows = polls.withColumn("done", F.sum("c").over(running)).crossJoin(F.broadcast(total))
    return reports.rates(rows).select("stage", "at", "done", F.round("rate", 9).alias("rate"), "eta")


@query("SELECT time_bucket(INTERVAL 1 HOUR, ts) AS start, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY ALL", prefix=False)
def throughput_windows(spark: SparkSession, d: str) -> DataFrame:
    return throughput(C.table(spark, d, "events")).withColumn("total", F.round("total", 4))


# Clip details, timelines and numbers as text.
_HIT_ROWS = f"hit_rows AS (SELECT path, h.reason AS reason, 0.0::DOUBLE AS t FROM (SELECT path, user_id, unnest([{_HITS}]) AS h FROM s) WHERE h.d <> 'good' AND NOT (h.tier = 'semantic' AND user_id % 97 = 0))"
_ITEMS = ((0, "missing_hands", "Hands in view"), (1, "phone", "No phone"), (2, "looking_away", "Eyes on the work"), (3, "light", "Enough light"))


@query(_HIT_ROWS + " SELECT path, reason, min(t) AS t FROM hit_rows GROUP BY path, reason")
def first_hits(spark: SparkSession, d: str) -> DataFrame:
    return reports.first_hits(C.results_u(spark, d))


@query(
    _HIT_ROWS
    + f", items(ord, id, label) AS (VALUES {', '.join(str(x) for x in _ITEMS)}) SELECT r.path, i.ord, i.id, i.label, CAST(NULL AS BOOLEAN) AS passed, (SELECT min(t) FROM hit_rows h WHERE h.path = r.path AND h.reason = i.id) AS first_t FROM results r, items i WHERE r.stage = 'vlm' AND r.version = 'cap'"
)
def rubric_first_hit(spark: SparkSession, d: str) -> DataFrame:
    return reports.rubric_rows(C.results_u(spark, d), spark.createDataFrame(_ITEMS, "ord int, id string, label string"))


@query("SELECT count(*) FILTER (stage IN ('cheap_cv', 'geometry', 'objects') AND version = 'c1') = 0 AND count(*) FILTER (stage = 'cheap_cv') > 0 AS is_snapshot FROM results")
def snapshot_detected(spark: SparkSession, d: str) -> DataFrame:
    return reports.snapshot_state(C.results_u(spark, d))


@query(
    "SELECT l_orderkey, l_linenumber, a AS seg_start, greatest(b, a) AS seg_end, 100.0::DOUBLE * a / 40 AS from_pct, 100.0::DOUBLE * greatest(b, a) / 40 AS to_pct FROM (SELECT l_orderkey, l_linenumber, least(greatest(l_quantity - 10, 0), 40) AS a, least(greatest(l_quantity + 5, 0), 40) AS b FROM lineitem)",
    prefix=False,
)
def segments_clamped(spark: SparkSession, d: str) -> DataFrame:
    inside = T.clamped(F.col("l_quantity") - 10, F.col("l_quantity") + 5, F.lit(40.0))
    return C.table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", inside.alias("s")).select("l_orderkey", "l_linenumber", F.col("s.start").alias("seg_start"), F.col("s.end").alias("seg_end"), "s.from_pct", "s.to_pct")


@query("SELECT event_id, len(x)::BIGINT AS n_times, x[2]::DOUBLE AS second FROM (SELECT event_id, regexp_extract_all('n:0 pts_time:0.5 n:1 pts_time:' || printf('%d.25', user_id) || ' pos:' || event_id, 'pts_time:([0-9]+(?:\\.[0-9]+)?)', 1) AS x FROM events)", prefix=False)
def decoder_times(spark: SparkSession, d: str) -> DataFrame:
    log = F.concat(F.lit("n:0 pts_time:0.5 n:1 pts_time:"), F.format_string("%d.25", "user_id"), F.lit(" pos:"), F.col("event_id").cast("string"))
    return C.table(spark, d, "events").select("event_id", T.pts_times(log).alias("x")).select("event_id", F.size("x").cast("long").alias("n_times"), F.element_at("x", 2).alias("second"))


@query(
    "SELECT o_orderkey, CASE WHEN n >= 1000000 THEN printf('%.1f MB', floor(n / 1000000.0::DOUBLE * 10 + 0.5) / 10) WHEN n >= 1000 THEN printf('%.1f kB', floor(n / 1000.0::DOUBLE * 10 + 0.5) / 10) ELSE n || ' B' END AS size, ((o_orderkey + 3) % 7)::BIGINT AS three_on FROM (SELECT o_orderkey, floor(o_totalprice * (1 + o_orderkey % 9))::BIGINT AS n FROM orders)",
    prefix=False,
)
def sizes_as_text(spark: SparkSession, d: str) -> DataFrame:
    n = F.floor(F.col("o_totalprice") * (1 + F.col("o_orderkey") % 9))
    return C.table(spark, d, "orders").select("o_orderkey", T.human_bytes(n).alias("size"), T.step(F.col("o_orderkey"), 3, F.lit(7)).cast("long").alias("three_on"))
