"""Clips, frames, results, judge and gold made from ordinary tables: synthetic stand-ins for video measurements.

Corpus U: a clip is a user's UTC day of `events`, its frames are the events in time order. Corpus D: a clip is one of
`documents`, its frames are the lines. The scores, the judge's verdicts and the extra versions are plain rules over these tables. PREFIX is the
same as SQL common table expressions (flat columns), for checks by another engine."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from bandsieve.functions.bands import SIGNALS, band, band_sql, worst, worst_sql
from bandsieve.functions.stats import round_to
from bandsieve.schema import VERDICT
from bandsieve.sources.store import exists, scratch_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def frames_u(spark: SparkSession, sf_dir: str) -> DataFrame:
    """path, user_id, i, t (seconds since the clip's first frame), value, event_type."""
    e = table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    path = F.concat_ws("/", F.lit("clips"), (F.col("user_id") % 4).cast("string"), F.col("user_id").cast("string"), F.date_format("ts", "yyyy-MM-dd"))
    order = Window.partitionBy("path").orderBy("ts", "event_id")
    at = F.unix_micros("ts")
    e = e.select(path.alias("path"), "user_id", "ts", "event_id", "value", "event_type")
    return e.select("path", "user_id", "ts", (F.row_number().over(order) - 1).alias("i"), ((at - F.min(at).over(Window.partitionBy("path"))) / 1e6).alias("t"), "value", "event_type", F.lag("value").over(order).alias("before"))


def features_u(frames: DataFrame) -> DataFrame:
    """One row a clip: unrounded scores."""
    share = lambda c: F.avg(F.when(c, 1.0).otherwise(0.0))
    v, kind = F.col("value"), F.col("event_type")
    return frames.groupBy("path", "user_id").agg(
        F.count(F.lit(1)).alias("n"),
        F.max(v).alias("top"),
        F.max(F.unix_micros("ts") / 1e6).alias("ran_at"),
        share(v < 5).alias("black"),
        share(kind == "view").alias("blur"),
        F.coalesce(F.median(F.abs(v - F.col("before")) / 500), F.lit(1.0)).alias("motion"),
        share(v < 20).alias("nohand"),
        F.least(F.max(v) / 500, F.lit(1.0)).alias("phone"),
        share(kind == "error").alias("looking_away"),
        share(kind == "signup").alias("no_workspace"),
    )




def _verdict(**fields: Column) -> Column:
    names = [f.name for f in VERDICT.fields]
    return F.struct(*[(fields[n] if n in fields else F.lit(None)).cast(f.dataType).alias(n) for n, f in zip(names, VERDICT.fields)])


_STORED: dict[tuple[str, str, str], str] = {}


def stored(spark: SparkSession, sf_dir: str, name: str, build: Callable[[], DataFrame], *parts: str) -> DataFrame:
    """A store's table for the tables in sf_dir, built and written once a session, as a cascade's runs would have left it."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    path = _STORED.get(key)
    if path is None or not exists(spark, path):
        path = _STORED[key] = scratch_path(spark)
        build().write.partitionBy(*parts).parquet(path)
    return spark.read.parquet(path)


def videos_u(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The catalog: path, embodiment, hash, n_frames, added_at. Every hundredth user's clips are cataloged but have no results."""
    return stored(spark, sf_dir, "videos", lambda: _videos(spark, sf_dir))


def _videos(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = features_u(frames_u(spark, sf_dir))
    return f.select("path", F.element_at(F.split("path", "/"), 2).alias("embodiment"), F.element_at(F.split("path", "/"), -1).alias("hash"), F.lit(None).cast("int").alias("n_frames"), F.col("ran_at").alias("added_at"))


def results_u(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The store's results for corpus U: five ungated cheap stages in version c1, older rows of geometry (c0), a partial newer run of objects (c2), the
    judge (cap) on two thirds of the unsure clips, and error rows in semantic."""
    rows = stored(spark, sf_dir, "results", lambda: _results(spark, sf_dir), "stage", "version")
    return rows.select("path", "stage", "version", "verdict", "score", "ran_at")


def _results(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = features_u(frames_u(spark, sf_dir)).filter("user_id % 100 <> 99")
    decide = lambda k: band(F.col({"static": "motion"}.get(k, k)), k)
    cheap = worst(decide("black"), decide("blur"), decide("static"))
    semantic = worst(decide("looking_away"), decide("no_workspace"))
    reasons = lambda *ks: F.filter(F.array(*[F.when(decide(k) != "good", n) for k, n in ks]), lambda x: x.isNotNull())
    hit = lambda k, name: F.when(decide(k) != "good", F.struct(F.lit(name).alias("reason"), F.lit(0.0).alias("t"), F.lit(None).cast("double").alias("conf")))
    hits = lambda *ks: F.filter(F.array(*[hit(k, n) for k, n in ks]), lambda x: x.isNotNull())
    corrupt = F.col("top") < 2
    error = F.col("user_id") % 97 == 0
    unsure = (cheap == "unsure") | (decide("nohand") == "unsure") | (decide("phone") == "unsure") | (semantic == "unsure") & ~error
    n = F.col("n")
    cv = (("black", "black"), ("blur", "blur"), ("static", "static"))
    word = F.when(n % 3 == 0, "PASS").when(n % 3 == 1, "BDLN").otherwise("FAIL")
    judged_bad = (word == "FAIL") | (n % 5 == 0)
    row = lambda on, stage, version, verdict, at=F.col("ran_at"): F.when(on, F.struct(F.lit(stage).alias("stage"), F.lit(version).alias("version"), verdict.alias("verdict"), at.alias("ran_at")))
    yes = F.lit(True)
    phone = _verdict(decision=decide("phone"), bad=decide("phone") != "good", reasons=reasons(("phone", "phone")), hits=hits(("phone", "phone")), phone_conf=round_to(F.col("phone"), 2))
    nohand = lambda k: _verdict(decision=decide("nohand"), bad=decide("nohand") != "good", reasons=reasons(("nohand", "missing_hands")), hits=hits(("nohand", "missing_hands")), nohand_frac=round_to(F.col("nohand") * k, 2))
    frac = F.create_map(F.lit("looking_away"), round_to(F.col("looking_away"), 2), F.lit("no_workspace"), round_to(F.col("no_workspace"), 2))
    rows = F.array(
        row(yes, "meta", "c1", _verdict(decision=F.when(corrupt, "bad").otherwise("good"), bad=corrupt, reasons=F.when(corrupt, F.array(F.lit("corrupt"))).otherwise(F.array().cast("array<string>")), dur=F.col("n").cast("double"))),
        row(yes, "cheap_cv", "c1", _verdict(decision=cheap, bad=cheap != "good", reasons=reasons(*cv), hits=hits(*cv), black_frac=round_to(F.col("black"), 2), blur_frac=round_to(F.col("blur"), 2), med_motion=round_to(F.col("motion"), 4))),
        row(yes, "geometry", "c1", nohand(1.0)),
        row(F.col("user_id") % 2 == 0, "geometry", "c0", nohand(0.5), F.col("ran_at") - 86400.0),
        row(yes, "objects", "c1", phone),
        row(F.col("user_id") % 10 == 0, "objects", "c2", phone, F.col("ran_at") + 1e6),
        row(~error, "semantic", "c1", _verdict(decision=semantic, bad=semantic != "good", reasons=reasons(("looking_away", "looking_away"), ("no_workspace", "no_workspace")), hits=hits(("looking_away", "looking_away"), ("no_workspace", "no_workspace")), frac=frac)),
        row(error, "semantic", "c1", _verdict(bad=yes, reasons=F.array(F.lit("error")), err=F.lit("poison"))),
        row(unsure & judge_turn(), "vlm", "cap", _verdict(bad=judged_bad, verdict=word, reasons=F.when(judged_bad, F.array(F.lit("looking_away"))).otherwise(F.array().cast("array<string>"))), F.col("ran_at") + 10.0),
    )
    return f.select("path", F.explode(F.filter(rows, lambda x: x.isNotNull())).alias("r")).select("path", "r.stage", "r.version", "r.verdict", F.lit(0.0).alias("score"), "r.ran_at")


def _case(rows: list[tuple[str, str]]) -> str:
    return "list_filter([" + ", ".join(f"CASE WHEN {d} <> 'good' THEN '{n}' END" for d, n in rows) + "], lambda x: x IS NOT NULL)"


def _prefix() -> str:
    col = {k: "motion" if k == "static" else k for k in SIGNALS}
    d = {k: f"d_{k}" for k in SIGNALS}
    decisions = ", ".join(f"{band_sql(col[k], k)} AS d_{k}" for k in SIGNALS)
    r2 = lambda x, n=2: f"floor({x} * {10**n}.0::DOUBLE + 0.5) / {10**n}.0::DOUBLE"
    base = ["path", "stage", "version", "ran_at", "decision", "bad", "reasons", "black_frac", "blur_frac", "med_motion", "nohand_frac", "phone_conf", "looking_away", "no_workspace", "verdict", "err"]

    def row(stage: str, version: str, where: str, at: str = "ran_at", **f: str) -> str:
        f = {"path": "path", "stage": f"'{stage}'", "version": f"'{version}'", "ran_at": at} | f
        kinds = {"decision": "VARCHAR", "bad": "BOOLEAN", "reasons": "VARCHAR[]", "verdict": "VARCHAR", "err": "VARCHAR"}
        return "SELECT " + ", ".join(f"({f[c] if c in f else 'NULL'})::{kinds[c]} AS {c}" if c in kinds else f"({f[c] if c in f else 'NULL'})::DOUBLE AS {c}" if c not in ("path", "stage", "version") else f"{f[c]} AS {c}" for c in base) + f" FROM s WHERE {where}"

    cv = _case([(d["black"], "black"), (d["blur"], "blur"), (d["static"], "static")])
    sem = _case([(d["looking_away"], "looking_away"), (d["no_workspace"], "no_workspace")])
    nohand = lambda k: {"decision": d["nohand"], "bad": f"{d['nohand']} <> 'good'", "reasons": _case([(d["nohand"], "missing_hands")]), "nohand_frac": r2(f"nohand * {k}::DOUBLE")}
    phone = {"decision": d["phone"], "bad": f"{d['phone']} <> 'good'", "reasons": _case([(d["phone"], "phone")]), "phone_conf": r2("phone")}
    word = "CASE WHEN n % 3 = 0 THEN 'PASS' WHEN n % 3 = 1 THEN 'BDLN' ELSE 'FAIL' END"
    jb = "(n % 3 = 2 OR n % 5 = 0)"
    rows = [
        row("meta", "c1", "true", decision="CASE WHEN top < 2 THEN 'bad' ELSE 'good' END", bad="top < 2", reasons="CASE WHEN top < 2 THEN ['corrupt'] ELSE [] END"),
        row("cheap_cv", "c1", "true", decision="d_cv", bad="d_cv <> 'good'", reasons=cv, black_frac=r2("black"), blur_frac=r2("blur"), med_motion=r2("motion", 4)),
        row("geometry", "c1", "true", **nohand("1.0")),
        row("geometry", "c0", "user_id % 2 = 0", "ran_at - 86400.0", **nohand("0.5")),
        row("objects", "c1", "true", **phone),
        row("objects", "c2", "user_id % 10 = 0", "ran_at + 1e6", **phone),
        row("semantic", "c1", "user_id % 97 <> 0", decision="d_sem", bad="d_sem <> 'good'", reasons=sem, looking_away=r2("looking_away"), no_workspace=r2("no_workspace")),
        row("semantic", "c1", "user_id % 97 = 0", bad="true", reasons="['error']", err="'poison'"),
        row("vlm", "cap", "judged", "ran_at + 10.0", bad=jb, verdict=word, reasons=f"CASE WHEN {jb} THEN ['looking_away'] ELSE [] END"),
    ]
    return f"""
WITH frames AS (SELECT *, row_number() OVER p - 1 AS i, (epoch_us(ts) - min(epoch_us(ts)) OVER (PARTITION BY path)) / 1e6 AS t, lag(value) OVER p AS before
  FROM (SELECT 'clips/' || (user_id % 4) || '/' || user_id || '/' || strftime(ts, '%Y-%m-%d') AS path, user_id, ts, event_id, value, event_type FROM events)
  WINDOW p AS (PARTITION BY path ORDER BY ts, event_id)),
 features AS (SELECT path, user_id, count(*) AS n, max(value) AS top, max(epoch_us(ts) / 1e6) AS ran_at, avg(CASE WHEN value < 5 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) AS black,
   avg(CASE WHEN event_type = 'view' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) AS blur, coalesce(median(abs(value - before) / 500), 1.0::DOUBLE) AS motion,
   avg(CASE WHEN value < 20 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) AS nohand, least(max(value) / 500, 1.0::DOUBLE) AS phone,
   avg(CASE WHEN event_type = 'error' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) AS looking_away, avg(CASE WHEN event_type = 'signup' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) AS no_workspace FROM frames GROUP BY path, user_id),
 videos AS (SELECT path, split_part(path, '/', 2) AS embodiment, split_part(path, '/', 4) AS hash, ran_at AS added_at FROM features),
 d1 AS (SELECT *, {decisions} FROM features WHERE user_id % 100 <> 99),
 d2 AS (SELECT *, {worst_sql(d["black"], d["blur"], d["static"])} AS d_cv, {worst_sql(d["looking_away"], d["no_workspace"])} AS d_sem FROM d1),
 s AS (SELECT *, (d_cv = 'unsure' OR d_nohand = 'unsure' OR d_phone = 'unsure' OR (d_sem = 'unsure' AND user_id % 97 <> 0)) AND judge_turn AS judged FROM d2 JOIN turns USING (path)),
 results AS ({' UNION ALL '.join(rows)})
"""


#: The share of unsure clips that the judge has seen, by a hash that other engines have too.
def judge_turn() -> Column:
    return F.conv(F.substring(F.md5("path"), 1, 8), 16, 10).cast("long") % 3 != 0


PREFIX = _prefix().replace(" videos AS (", " turns AS (SELECT path, ('0x' || substr(md5(path), 1, 8))::BIGINT % 3 <> 0 AS judge_turn FROM features),\n videos AS (", 1)


def frames_d(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Corpus D's frames: path (doc_id), i, luma (the line's length), before (the line's before)."""
    d = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("path"), "source", F.posexplode(F.split("text", "\n")).alias("i", "line")).withColumn("luma", F.length("line"))
    return d.withColumn("before", F.lag("luma").over(Window.partitionBy("path").orderBy("i"))).drop("line")
