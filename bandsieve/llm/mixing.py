"""Mixing sources to target weights by hash-threshold histograms, in DataFrame operations only.

Each source gets a target of words; a document is taken whole, `full` times for its source's whole repeats and once
more if its hash is at most its source's threshold. The threshold is found without sorting: sizes are summed by source
and leading hash bits, the bucket in which the budget runs out is found from the running sums, and only that bucket is
summed again by its next bits, until one hash value is left. That value is taken if at least half of it fits.

Sources are in code point order with null last and weigh `weights` in turn. They share all words by weight; a target stops
at `max_repeats` times its source's words, and the excess goes to the others by weight until none is above.

A null text has size 0, and a document of size 0 takes 0 words. Rows with the same id share a hash and so a fate. A null
source is a source. A null id has a hash of its own. Extra columns don't matter: id, text and source are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bandsieve.llm._shared import WORD, broadcast_if_small, materialize, tidy

HASH_BITS = 60
BITS = 10


def doc_hash(id_col: str, seed: int) -> Column:
    """60 bits of MD5 over the seed and the id, as a long."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit("null")))
    return F.conv(F.substring(F.md5(text), 1, HASH_BITS // 4), 16, 10).cast("long")


def word_count(text_col: str) -> Column:
    return F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = (5, 2, 1), max_repeats: int = 3) -> DataFrame:
    """key, source_size, target of each source; sizes has key, source and size of each document.

    With sources in order of cap by weight, the common level is the largest of (words left when all before are
    capped) by (weight left): a closed form of resharing until no target is above its cap. One row a source meets in one task."""
    by = sizes.groupBy("key", "source").agg(F.sum("size").alias("source_size"))
    turn = F.pmod(F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1, F.lit(len(weights)))
    weight = F.element_at(F.array(*map(F.lit, weights)), (turn + 1).cast("int"))
    by = by.withColumn("weight", weight.cast("long")).withColumn("cap", F.lit(max_repeats) * F.col("source_size"))
    order = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    everything = Window.partitionBy(F.lit(0))
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    after = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    left = F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0))
    level = by.withColumn("level", left / F.sum("weight").over(after))
    target = F.least(F.col("cap").cast("double"), F.max("level").over(everything) * F.col("weight"))
    return level.select("key", "source_size", target.alias("target"))


def boundaries(sizes: DataFrame, budgets: DataFrame) -> DataFrame:
    """key and threshold: the largest hash that is taken for each key's budget (-1: none).

    budgets: key, budget. Each round reads id-sized rows and sums those in the keys' boundary buckets only."""
    state = materialize(budgets.select("key", F.col("budget").cast("double").alias("budget"), F.lit(0).cast("long").alias("prefix"), F.lit(None).cast("long").alias("threshold")))
    for shift in range(HASH_BITS - BITS, -1, -BITS):
        open_ = state.filter("threshold is null")
        own = sizes.join(broadcast_if_small(open_.select("key", "prefix")), "key").filter(F.shiftright("h", shift + BITS) == F.col("prefix"))
        cells = own.groupBy("key", F.shiftright("h", shift).alias("cell")).agg(F.sum("size").alias("size"), F.min("h").alias("low"), F.max("h").alias("high"))
        running = Window.partitionBy("key").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
        cells = cells.withColumn("before", F.coalesce(F.sum("size").over(running), F.lit(0)))
        # The first cell that does not fit whole.
        edge = cells.join(open_.select("key", "budget"), "key").filter(F.col("before") + F.col("size") > F.col("budget")).groupBy("key").agg(F.min_by(F.struct("cell", "size", "low", "high", "before"), "cell").alias("e"))
        fits = F.col("e.before") + F.col("e.size") / 2 <= F.col("budget")
        single = F.col("e.low") == F.col("e.high")
        end = (F.col("prefix") + 1) * F.lit(1 << (shift + BITS)) - 1 if shift + BITS < HASH_BITS else F.lit((1 << HASH_BITS) - 1).cast("long")
        new = (
            F.when(F.col("threshold").isNotNull(), F.col("threshold"))
            .when(F.col("e").isNull(), end)  # everything here fits
            .when(single, F.when(fits, F.col("e.low")).otherwise(F.col("e.low") - 1))
        )
        state = materialize(
            state.join(edge, "key", "left").select(
                "key",
                F.when(F.col("e").isNotNull(), F.col("budget") - F.col("e.before")).otherwise(F.col("budget")).alias("budget"),
                F.coalesce(F.col("e.cell"), F.col("prefix")).alias("prefix"),
                new.alias("threshold"),
            )
        )
        if state.filter("threshold is null").isEmpty():
            break
    return state.select("key", "threshold")


@tidy
def mix_sources(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: tuple[int, ...] = (5, 2, 1), max_repeats: int = 3, seed: int = 20) -> DataFrame:
    """Columns: the id, size, source_size, target (the source's), repeats (times the document is taken), taken (words)."""
    source = F.col(source_col).cast("string")
    key = F.when(source.isNull(), F.lit("n")).otherwise(F.concat(F.lit("s"), source))
    sizes = materialize(docs.select(F.col(id_col).alias("id"), source.alias("source"), key.alias("key"), word_count(text_col).alias("size"), doc_hash(id_col, seed).alias("h")))
    targets = source_targets(sizes, weights, max_repeats)
    full = F.when(F.col("source_size") > 0, F.least(F.lit(max_repeats), F.floor(F.col("target") / F.col("source_size")))).otherwise(0).cast("long")
    plan = materialize(targets.withColumn("full", full).withColumn("budget", F.when(F.col("full") < max_repeats, F.col("target") - F.col("full") * F.col("source_size")).otherwise(0.0)))
    state = plan.join(boundaries(sizes, plan.select("key", "budget")), "key").select("key", "source_size", "target", "full", "threshold")
    out = sizes.join(broadcast_if_small(materialize(state)), "key")
    repeats = F.col("full") + F.when((F.col("h") <= F.col("threshold")) & (F.col("full") < max_repeats), 1).otherwise(0)
    return out.select(F.col("id").alias(id_col), "size", "source_size", "target", repeats.alias("repeats"), (F.col("size") * repeats).alias("taken"))


ORACLE_SQL = """
WITH s AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size,
             ('0x' || substr(md5('20:' || coalesce(doc_id::VARCHAR, 'null')), 1, 15))::BIGINT AS h FROM documents),
 t AS (SELECT source, sum(size)::BIGINT AS source_size FROM s GROUP BY source),
 w AS (SELECT *, [5, 2, 1][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS weight, 3 * source_size AS cap FROM t),
 l AS (SELECT *, ((sum(source_size) OVER () - coalesce(sum(cap) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
             / (sum(weight) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::DOUBLE) AS level FROM w),
 g AS (SELECT source, source_size, least(cap::DOUBLE, max(level) OVER () * weight) AS target FROM l),
 f AS (SELECT *, CASE WHEN source_size > 0 THEN least(3, floor(target / source_size)) ELSE 0 END::BIGINT AS full_times FROM g),
 c AS (SELECT h, source, sum(size) AS hs FROM s GROUP BY ALL),
 r AS (SELECT h, source, hs, coalesce(sum(hs) OVER (PARTITION BY source ORDER BY h ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM c),
 x AS (SELECT s.doc_id, s.size, f.source_size, f.target, f.full_times + CASE WHEN f.full_times < 3 AND (r.before + r.hs <= f.target - f.full_times * f.source_size OR r.before + r.hs / 2 <= f.target - f.full_times * f.source_size) THEN 1 ELSE 0 END AS repeats
   FROM s JOIN f ON s.source IS NOT DISTINCT FROM f.source JOIN r ON s.h = r.h AND s.source IS NOT DISTINCT FROM r.source)
SELECT doc_id, size, source_size, target, repeats::BIGINT AS repeats, (size * repeats)::BIGINT AS taken FROM x
"""
