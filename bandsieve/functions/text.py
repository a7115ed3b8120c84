"""Small scalars around clips: times in a decoder's log, segments of a timeline, steps through a list, and numbers as people read them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def pts_times(log: Column) -> Column:
    """All presentation times in a decoder's log, in order, as an array of doubles; a null log has none."""
    found = F.regexp_extract_all(F.coalesce(log, F.lit("")), F.lit(r"pts_time:([0-9]+(?:\.[0-9]+)?)"), F.lit(1))
    return F.transform(found, lambda x: x.cast("double"))


def even_times(duration: Column, n: int) -> Column:
    """n times evenly spaced inside a clip, for clips whose keyframes can't be read; none where the duration isn't positive."""
    times = F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda i: duration * (i + 0.5) / n)
    return F.when(duration > 0, times).otherwise(F.array().cast("array<double>"))


def clamped(start: Column, end: Column, duration: Column) -> Column:
    """A segment held within [0, duration], as a struct of start, end and both as percentages; null where there is no duration."""
    inside = lambda x: F.least(F.greatest(x, F.lit(0.0)), duration)
    s = inside(start)
    e = F.greatest(inside(end), s)
    return F.when(duration > 0, F.struct(s.alias("start"), e.alias("end"), (100.0 * s / duration).alias("from_pct"), (100.0 * e / duration).alias("to_pct")))


def step(place: Column, by: int, size: Column) -> Column:
    """The place `by` steps on in a list that closes to a ring; null for an empty list."""
    return F.when(size > 0, F.pmod(place + by, size))


def percent(part: Column, whole: Column) -> Column:
    """Like 12.5%; of nothing, 0.0%."""
    share = F.when(whole > 0, F.floor(1000.0 * part / whole + 0.5) / 10.0).otherwise(0.0)
    return F.format_string("%.1f%%", share)


def human_bytes(n: Column) -> Column:
    """Like 1.5 MB, in steps of 1,000."""
    out = F.concat(n.cast("string"), F.lit(" B"))
    for power, unit in enumerate(("kB", "MB", "GB", "TB", "PB"), 1):
        out = F.when(n >= 1000**power, F.format_string(f"%.1f {unit}", F.floor(n / float(1000**power) * 10 + 0.5) / 10.0)).otherwise(out)
    return out


def human_seconds(seconds: Column) -> Column:
    """Like 2h05m, 7m30s or 12s; null where there is no estimate."""
    s = F.floor(seconds).cast("long")
    two = lambda x: F.lpad(x.cast("string"), 2, "0")
    hours, minutes = F.floor(s / 3600).cast("string"), F.floor(s / 60)
    return F.when(s >= 3600, F.concat(hours, F.lit("h"), two(F.floor(s % 3600 / 60)), F.lit("m"))).when(s >= 60, F.concat(minutes.cast("string"), F.lit("m"), two(s % 60), F.lit("s"))).when(s >= 0, F.concat(s.cast("string"), F.lit("s")))
