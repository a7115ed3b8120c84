"""Streams: new files, new clips to score, and throughput over time."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from bandsieve.operators.stages import Stage, run_stage
from bandsieve.sources.store import Store, insert_if_absent

_FILES = T.StructType([T.StructField("path", T.StringType()), T.StructField("modificationTime", T.TimestampType()), T.StructField("length", T.LongType()), T.StructField("content", T.BinaryType())])


def new_files(spark: SparkSession, root: str, pattern: str = "*.mp4") -> DataFrame:
    """A stream of files as they appear: path and length; contents are not read."""
    files = spark.readStream.format("binaryFile").schema(_FILES).option("pathGlobFilter", pattern).option("recursiveFileLookup", True).load(root)
    return files.select("path", "length", "modificationTime")


def score_stream(clips: DataFrame, store: Store, stage: Stage, checkpoint: str) -> StreamingQuery:
    """Scores each micro-batch's clips (path) that have no row yet. A batch that is run again after a failure adds nothing twice."""

    def one(batch: DataFrame, batch_id: int) -> None:
        done = store.results().filter((F.col("stage") == stage.name) & (F.col("version") == stage.version))
        rows = run_stage(insert_if_absent(done, batch.select("path"), ["path"]), stage, float(batch_id))
        store.add_results(rows)

    return clips.writeStream.foreachBatch(one).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def throughput(events: DataFrame, width: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """Extension: events and values by kind in tumbling windows; on a stream, rows later than `late` are dropped by the watermark."""
    rows = events.withWatermark("ts", late) if events.isStreaming else events
    out = rows.groupBy(F.window("ts", width).alias("w"), "event_type").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"))
    return out.select(F.col("w.start").alias("start"), "event_type", "n", "total")
