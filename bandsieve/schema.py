"""Schemas of the store's tables. The verdict is one nullable superset of what the stages write."""

from __future__ import annotations

from pyspark.sql import types as T

S, L, D, B, I = T.StringType(), T.LongType(), T.DoubleType(), T.BooleanType(), T.IntegerType()  # noqa: E741


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(k, v) for k, v in fields.items()])


HITS = T.ArrayType(_struct(reason=S, t=D, conf=D))
VERDICT = _struct(
    decision=S, bad=B, reasons=T.ArrayType(S), hits=HITS, bitrate=D, dur=D, black_frac=D, blur_frac=D, med_motion=D, nohand_frac=D, phone_conf=D, frac=T.MapType(S, D),
    verdict=S, by=S, scene=S, judge_note=S, rubric=T.ArrayType(T.StructType([T.StructField("id", S), T.StructField("pass", B)])), looked_at=T.ArrayType(D),
    embedded=B, encoder=S, dim=I, n_frames=I, err=S,
)
VIDEOS = _struct(path=S, embodiment=S, hash=S, n_frames=I, added_at=D)
RESULTS = T.StructType([T.StructField("path", S), T.StructField("stage", S), T.StructField("version", S), T.StructField("verdict", VERDICT), T.StructField("score", D), T.StructField("ran_at", D)])
RUNS = _struct(run_id=L, stage=S, version=S, params_json=S, started=D, finished=D, n_done=I)
EVAL = _struct(stage=S, version=S, category=S, precision=D, recall=D, f1=D, n_gold=I, ran_at=D)
GOLD = _struct(video=S, reasons=T.ArrayType(S), _vlm=S)
RUBRIC = T.StructType([T.StructField("task", S), T.StructField("scene", S), T.StructField("items", T.ArrayType(T.StructType([T.StructField(k, S) for k in ("id", "label", "desc", "fail_if")] + [T.StructField("borderline", B)])))])
VECTORS = T.StructType([T.StructField("id", S), T.StructField("encoder", S), T.StructField("pooled", T.ArrayType(T.FloatType())), T.StructField("frames", T.ArrayType(T.ArrayType(T.FloatType())))])

#: Rungs in order, with level and active version. Cheap rungs decide; the judge takes what they leave unsure.
CHEAP_STAGES = ("meta", "cheap_cv", "geometry", "objects", "semantic")
STAGES = CHEAP_STAGES + ("vlm",)
LEVELS = {"meta": "L0", "cheap_cv": "L1", "geometry": "L2", "objects": "L3", "semantic": "L3", "vlm": "L4", "embed": "Lx"}
ACTIVE_VERSIONS = {s: "c1" for s in CHEAP_STAGES} | {"vlm": "cap"}
