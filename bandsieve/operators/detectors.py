"""Verdicts from what probes, frames and models measured, and stages around injected decoders and models.

Decoding and models stay behind callables: `frames(path)` gives (uint8 array of shape n, h, w, 3 in RGB; seconds), and models are
made once a worker. The verdicts themselves are plain arithmetic on arrays."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Any

import numpy as np
from pyspark.sql import DataFrame

from bandsieve.functions.bands import DEFAULT_BANDS, SIGNALS, Bands
from bandsieve.operators.stages import Stage, Verdict

Frames = Callable[[str], tuple[np.ndarray, list[float]]]
MOST_HITS = 30
EMPTY: Verdict = {"decision": "bad", "bad": True, "reasons": ["empty"], "hits": []}
_WORKER: dict[str, Any] = {}


def once(name: str, make: Callable[[], Any]) -> Any:
    """A model made when a worker first needs it."""
    if name not in _WORKER:
        _WORKER[name] = make()
    return _WORKER[name]


def band_of(value: float, signal: str, bands: Bands = DEFAULT_BANDS) -> str:
    """The band of one number; the same rule as functions.bands.band."""
    lo, hi = bands[signal]
    over, under = ("good", "bad") if SIGNALS[signal].low_is_bad else ("bad", "good")
    return over if value > hi else under if value < lo else "unsure"


def worst_of(decisions: list[str]) -> str:
    return next((x for x in ("bad", "unsure") if x in decisions), "good")


def _verdict(decisions: dict[str, str], hits: list[dict], **scores: Any) -> Verdict:
    decision = worst_of(list(decisions.values()))
    reasons = [k for k, d in decisions.items() if d != "good"]
    return {"decision": decision, "bad": decision != "good", "reasons": reasons, "hits": [h for h in hits if h["reason"] in reasons][:MOST_HITS], **scores}


def container(duration: float, bitrate: float) -> Verdict:
    """Without duration the file is empty; with next to no bits a second it is corrupt."""
    reasons = ["empty"] * (duration == 0) + ["corrupt"] * (0 < bitrate < 1000)
    return {"decision": "bad" if reasons else "good", "bad": bool(reasons), "reasons": reasons, "bitrate": bitrate, "dur": round(duration, 1)}


def sharpness(gray: np.ndarray) -> float:
    """Variance of the four-neighbour Laplacian, edges mirrored."""
    p = np.pad(gray.astype(np.float64), 1, mode="reflect")
    return float((p[:-2, 1:-1] + p[2:, 1:-1] + p[1:-1, :-2] + p[1:-1, 2:] - 4 * p[1:-1, 1:-1]).var())


def camera(frames: np.ndarray, times: list[float], bands: Bands = DEFAULT_BANDS) -> Verdict:
    """Dark and blurred shares of the frames, and the median motion from frame to frame."""
    if not len(frames):
        return dict(EMPTY)
    gray = np.rint(frames.astype(np.float64) @ np.array([0.299, 0.587, 0.114]))
    dark, blurred = gray.mean((1, 2)) < 16, np.array([sharpness(g) for g in gray]) < 100
    motion = float(np.median(np.abs(np.diff(gray, axis=0)).mean((1, 2)) / 255)) if len(gray) > 1 else 1.0
    decisions = {"black": band_of(float(dark.mean()), "black", bands), "blur": band_of(float(blurred.mean()), "blur", bands), "static": band_of(motion, "static", bands)}
    hits = [{"reason": name, "t": round(float(times[i]), 1)} for name, on in (("black", dark), ("blur", blurred)) for i in np.flatnonzero(on)]
    return _verdict(decisions, [*hits, {"reason": "static", "t": 0.0}], black_frac=round(float(dark.mean()), 2), blur_frac=round(float(blurred.mean()), 2), med_motion=round(motion, 4))


def hands(seen: list[bool], times: list[float], bands: Bands = DEFAULT_BANDS) -> Verdict:
    """Share of frames in which no hand was seen."""
    if not seen:
        return dict(EMPTY)
    share = 1 - sum(seen) / len(seen)
    hits = [{"reason": "missing_hands", "t": round(t, 1)} for t, yes in zip(times, seen) if not yes]
    return _verdict({"missing_hands": band_of(share, "nohand", bands)}, hits, nohand_frac=round(share, 2))


def phone(confidences: list[float], times: list[float], bands: Bands = DEFAULT_BANDS) -> Verdict:
    """The highest confidence of a phone over the frames (0 where none was found)."""
    if not confidences:
        return dict(EMPTY)
    hits = [{"reason": "phone", "t": round(t, 1), "conf": round(c, 2)} for t, c in zip(times, confidences) if c > 0]
    return _verdict({"phone": band_of(max(confidences), "phone", bands)}, hits, phone_conf=round(max(confidences), 2))


def scene(similarity: np.ndarray, times: list[float], groups: list[str], bands: Bands = DEFAULT_BANDS) -> Verdict:
    """similarity: frames x prompts; groups: each prompt's group. A frame goes to its best prompt's group, ties to the first."""
    if not len(similarity):
        return dict(EMPTY)
    won = [groups[i] for i in similarity.argmax(1)]
    share = {g: won.count(g) / len(won) for g in dict.fromkeys(groups)}
    decisions = {g: band_of(share.get(g, 0.0), g, bands) for g in ("looking_away", "no_workspace")}
    return _verdict(decisions, [{"reason": g, "t": round(t, 1)} for g, t in zip(won, times)], frac={g: round(x, 2) for g, x in share.items()})


def container_stage(probe: Callable[[str], tuple[float, float]]) -> Stage:
    """probe(path) gives (duration, bitrate); a probe that fails makes the clip bad."""

    def look(path: str) -> Verdict:
        try:
            return container(*probe(path))
        except Exception as e:  # noqa: BLE001
            return {"decision": "bad", "bad": True, "reasons": ["probe_fail"], "err": str(e)[:80]}

    return Stage("meta", "c1", look, workers=12, trigger="bad if corrupt or empty")


def camera_stage(frames: Frames) -> Stage:
    return Stage("cheap_cv", "c1", lambda path: camera(*frames(path)), workers=8, trigger="dark, blurred or still")


def hands_stage(frames: Frames, make_detector: Callable[[], Callable[[np.ndarray], bool]]) -> Stage:
    def look(path: str) -> Verdict:
        pixels, times = frames(path)
        return hands([once("hands", make_detector)(f) for f in pixels], times)

    return Stage("geometry", "c1", look, workers=6, trigger="frames without hands")


def phone_stage(frames: Frames, make_detector: Callable[[], Callable[[np.ndarray], list[float]]]) -> Stage:
    def look(path: str) -> Verdict:
        pixels, times = frames(path)
        return phone(once("phone", make_detector)(pixels) if len(pixels) else [], times)

    return Stage("objects", "c1", look, workers=3, trigger="a phone in a frame")


def _pooled(paths: list[str], frames: Frames) -> tuple[np.ndarray | None, dict[str, tuple[int, int, list[float]]]]:
    """All clips' frames in one array, and where each clip's are."""
    parts, where, at = [], {}, 0
    for p in paths:
        pixels, times = frames(p)
        where[p] = (at, at + len(pixels), times)
        at += len(pixels)
        if len(pixels):
            parts.append(pixels)
    return (np.concatenate(parts) if parts else None), where


def scene_stage(frames: Frames, make_model: Callable[[], Callable[[np.ndarray], np.ndarray]], groups: list[str]) -> Stage:
    """The model gets the pooled frames of up to 256 clips and gives similarities to the prompts."""

    def look(paths: list[str]) -> dict[str, Verdict]:
        pixels, where = _pooled(paths, frames)
        sim = once("scene", make_model)(pixels) if pixels is not None else np.empty((0, len(groups)))
        return {p: scene(sim[a:b], times, groups) for p, (a, b, times) in where.items()}

    return Stage("semantic", "c1", batch_fn=look, batch_size=256, workers=3, trigger="away from the task, or no workspace")


def embed(clips: DataFrame, frames: Frames, make_encoder: Callable[[], Callable[[np.ndarray], np.ndarray]], encoder: str, batch: int = 256) -> DataFrame:
    """id, encoder, pooled (the mean frame vector) and frames of each clip (path) that has any frames."""

    def work(parts: Iterator[Any]) -> Iterator[Any]:
        import pandas as pd

        for part in parts:
            paths = part["path"].tolist()
            for lo in range(0, len(paths), batch):
                pixels, where = _pooled(paths[lo : lo + batch], frames)
                if pixels is None:
                    continue
                v = once(f"encoder {encoder}", make_encoder)(pixels)
                rows = [(p, encoder, v[a:b].mean(0).tolist(), v[a:b].tolist()) for p, (a, b, _) in where.items() if b > a]
                yield pd.DataFrame(rows, columns=["id", "encoder", "pooled", "frames"])

    return clips.select("path").mapInPandas(work, "id string, encoder string, pooled array<float>, frames array<array<float>>")
