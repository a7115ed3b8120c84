"""Bands, decisions and signals as Column expressions; the same rules as SQL text for other engines."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

Bands = Mapping[str, tuple[float, float]]


@dataclass(frozen=True)
class Signal:
    """A raw score: its stage, its field in the verdict, what counts when the field is missing, and its histogram's end."""

    stage: str
    field: str
    missing: float
    maximum: float
    low_is_bad: bool = False


# The shipped bands and the signals' scales.
DEFAULT_BANDS: dict[str, tuple[float, float]] = {
    "black": (0.1, 0.5),
    "blur": (0.5, 0.9),
    "static": (0.002, 0.01),
    "nohand": (0.3, 0.8),
    "phone": (0.35, 0.6),
    "looking_away": (0.3, 0.7),
    "no_workspace": (0.3, 0.7),
}
SIGNALS: dict[str, Signal] = {
    "black": Signal("cheap_cv", "black_frac", 0.0, 1.0),
    "blur": Signal("cheap_cv", "blur_frac", 0.0, 1.0),
    "static": Signal("cheap_cv", "med_motion", 1.0, 0.05, True),
    "nohand": Signal("geometry", "nohand_frac", 0.0, 1.0),
    "phone": Signal("objects", "phone_conf", 0.0, 1.0),
    "looking_away": Signal("semantic", "frac.looking_away", 0.0, 1.0),
    "no_workspace": Signal("semantic", "frac.no_workspace", 0.0, 1.0),
}
#: The field whose presence says that a stage's row has scores.
HAS_SCORES = {"cheap_cv": "blur_frac", "geometry": "nohand_frac", "objects": "phone_conf", "semantic": "frac"}


def overlay(posted: Mapping[str, tuple[float, float]] | None, base: Bands = DEFAULT_BANDS) -> dict[str, tuple[float, float]]:
    """Base bands with posted ones over them; unknown signals are left out. A band whose low end is above its high end is refused."""
    out = dict(base)
    for name, (lo, hi) in (posted or {}).items():
        if name in out:
            if not float(lo) <= float(hi):
                raise ValueError(f"band of {name}: {lo} is above {hi}")
            out[name] = (float(lo), float(hi))
    return out


def band(value: Column, signal: str, bands: Bands = DEFAULT_BANDS) -> Column:
    """bad, good or unsure; a value at either edge, and NaN, is unsure. Null gives null."""
    lo, hi = bands[signal]
    above, below = ("good", "bad") if SIGNALS[signal].low_is_bad else ("bad", "good")
    return F.when(value.isNull(), F.lit(None).cast("string")).when(F.isnan(value), "unsure").when(value > hi, above).when(value < lo, below).otherwise("unsure")


def worst(*decisions: Column) -> Column:
    """bad over unsure over good."""
    is_ = lambda x: F.coalesce(*[F.when(d == x, True) for d in decisions], F.lit(False))
    return F.when(is_("bad"), "bad").when(is_("unsure"), "unsure").otherwise("good")


def score(signal: str, verdict: Column | None = None) -> Column:
    v = F.col("verdict") if verdict is None else verdict
    name, _, key = SIGNALS[signal].field.partition(".")
    return v[name][key] if key else v[name]


def decide(bands: Bands = DEFAULT_BANDS, stage: Column | None = None, verdict: Column | None = None) -> Column:
    """A stage's decision derived anew from stored scores; without scores the stored decision, else the bad flag."""
    s, v = F.col("stage") if stage is None else stage, F.col("verdict") if verdict is None else verdict
    stored = F.coalesce(v["decision"], F.when(F.coalesce(v["bad"], F.lit(False)), "bad").otherwise("good"))
    out = F.when(F.lit(False), "good")
    for name, field in HAS_SCORES.items():
        own = [band(F.coalesce(score(k, v), F.lit(x.missing)), k, bands) for k, x in SIGNALS.items() if x.stage == name]
        out = out.when((s == name) & v[field].isNotNull(), worst(*own) if len(own) > 1 else own[0])
    return out.otherwise(stored)


def signals_long(results, stages: bool = True):  # noqa: ANN001, ANN201
    """One row for each clip and signal that has a score: path, signal, stage, value. One pass over the rows."""
    cells = [F.struct(F.lit(k).alias("signal"), F.when(F.col("stage") == x.stage, score(k)).alias("value")) for k, x in SIGNALS.items()]
    return results.select("path", "stage", F.explode(F.array(*cells)).alias("x")).select("path", "x.signal", "stage", "x.value").filter("value is not null")


def normalise_verdict(text: Column) -> Column:
    """A judge's word as PASS, BDLN or FAIL."""
    up = F.upper(text)
    return F.when(up.startswith("BORD") | (up == "BDLN"), "BDLN").when(up == "FAIL", "FAIL").otherwise("PASS")


def judge_label(verdict: Column) -> Column:
    return F.when(F.coalesce(verdict["bad"], F.lit(False)) | F.coalesce(verdict["verdict"] == "FAIL", F.lit(False)), "bad").otherwise("good")


def is_flagged(verdict: Column) -> Column:
    return F.coalesce(verdict["bad"], F.lit(False))


def is_bad(verdict: Column) -> Column:
    """The stored decision is bad; rows without a decision go by the flag."""
    return F.coalesce(verdict["decision"] == "bad", F.coalesce(verdict["bad"], F.lit(False)))


# The same rules as SQL over flat columns (decision, bad, scores), for checks by another engine.


def band_sql(value: str, signal: str, bands: Bands = DEFAULT_BANDS) -> str:
    lo, hi = bands[signal]
    above, below = ("good", "bad") if SIGNALS[signal].low_is_bad else ("bad", "good")
    return f"CASE WHEN {value} IS NULL THEN NULL WHEN isnan({value}) THEN 'unsure' WHEN {value} > {hi} THEN '{above}' WHEN {value} < {lo} THEN '{below}' ELSE 'unsure' END"


def worst_sql(*decisions: str) -> str:
    many = ", ".join(decisions)
    return f"CASE WHEN 'bad' IN ({many}) THEN 'bad' WHEN 'unsure' IN ({many}) THEN 'unsure' ELSE 'good' END"


def decide_sql(bands: Bands = DEFAULT_BANDS) -> str:
    out = "CASE"
    for name, field in HAS_SCORES.items():
        own = [band_sql(f"coalesce({x.field.split('.')[-1]}, {x.missing}::DOUBLE)", k, bands) for k, x in SIGNALS.items() if x.stage == name]
        has = "looking_away" if field == "frac" else field
        out += f" WHEN stage = '{name}' AND {has} IS NOT NULL THEN {worst_sql(*own) if len(own) > 1 else own[0]}"
    return out + " ELSE coalesce(decision, CASE WHEN bad THEN 'bad' ELSE 'good' END) END"
