"""Histograms, quantiles and rounding."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def round_to(x: Column, places: int) -> Column:
    """Half up, by plain arithmetic: the same in any engine with IEEE doubles."""
    return F.floor(x * float(10**places) + 0.5).cast("double") / float(10**places)


def bin_of(value: Column, maximum: Column | float, bins: int) -> Column:
    """A fixed-width bin, clamped at both ends; 0 where the maximum is 0."""
    top = maximum if isinstance(maximum, Column) else F.lit(float(maximum))
    return F.when(top == 0, 0).otherwise(F.least(F.lit(bins - 1), F.greatest(F.lit(0), F.floor(value / top * bins)))).cast("int")


def is_finite(value: Column) -> Column:
    return ~F.isnan(value) & (F.abs(value) < float("inf"))


def histogram(values: DataFrame, keys: list[str], maximum: Column, bins: int, counts: dict[str, Column]) -> DataFrame:
    """keys, bin and the counts of each bin, empty bins included. Partial counts before the shuffle, bins x keys rows after it."""
    have = values.filter(is_finite(F.col("value"))).groupBy(*keys, bin_of(F.col("value"), maximum, bins).alias("bin")).agg(*[F.count_if(c).alias(k) for k, c in counts.items()])
    every = values.select(*keys).distinct().select(*keys, F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    return every.join(have, [*keys, "bin"], "left").fillna(0, list(counts))


def nearest_rank(values: DataFrame, keys: list[str], fractions: dict[str, float], cells: int = 4096) -> DataFrame:
    """The element at index round((n - 1) * fraction), ties to even, of each key's sorted values.

    Values are counted in `cells` ranges of equal width a key; only the ranges that hold a wanted index are then sorted, by distinct value. Without the
    ranges a key's values would all meet in one task. Infinite values and NaN keep the order that sorting gives them."""
    finite = F.when(is_finite(F.col("value")), F.col("value"))
    ends = values.groupBy(*keys).agg(F.min(finite).alias("_lo"), F.max(finite).alias("_hi"))
    share = (F.col("value") - F.col("_lo")) / (F.col("_hi") - F.col("_lo"))
    cell = (
        F.when(F.isnan("value") | (F.col("value") == float("inf")), F.lit(cells))
        .when(F.col("value") == float("-inf"), F.lit(-1))
        .when(F.col("_hi") == F.col("_lo"), F.lit(0))
        .otherwise(F.least(F.lit(cells - 1), F.floor(share * cells).cast("int")))
    )
    one = values.filter("value is not null").groupBy(*keys, "value").agg(F.count(F.lit(1)).alias("_c"))
    placed = one.join(ends, keys).withColumn("_cell", cell).select(*keys, "value", "_c", "_cell")
    by_cell = placed.groupBy(*keys, "_cell").agg(F.sum("_c").alias("_in"))
    order, everything = Window.partitionBy(*keys).orderBy("_cell"), Window.partitionBy(*keys)
    counted = by_cell.withColumn("_end", F.sum("_in").over(order.rowsBetween(Window.unboundedPreceding, 0))).withColumn("_n", F.sum("_in").over(everything))
    wanted = F.array(*[F.struct(F.lit(name).alias("name"), F.bround((F.col("_n") - 1) * f, 0).alias("at")) for name, f in fractions.items()])
    held = F.filter(wanted, lambda x: (x["at"] < F.col("_end")) & (x["at"] >= F.col("_end") - F.col("_in")))
    picked = counted.withColumn("_held", held).filter(F.size("_held") > 0).select(*keys, "_cell", "_held", (F.col("_end") - F.col("_in")).alias("_before"))
    inner = Window.partitionBy(*keys, "_cell").orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
    ranked = placed.join(picked, [*keys, "_cell"]).withColumn("_end", F.col("_before") + F.sum("_c").over(inner)).select(*keys, "value", "_c", "_end", F.explode("_held").alias("_w"))
    hit = ranked.filter((F.col("_w.at") < F.col("_end")) & (F.col("_w.at") >= F.col("_end") - F.col("_c")))
    out = hit.groupBy(*keys).agg(*[round_to(F.max(F.when(F.col("_w.name") == name, F.col("value"))), 6).alias(name) for name in fractions])
    return out
