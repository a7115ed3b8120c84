"""Exact dedup by a tree merge of sorted digest runs.

Every partition hashes its rows and combines them into a run with one entry for each digest: the best identifier
there (smallest or largest) and a count. Runs are then exchanged in binomial rounds: with `fan` 2^k a round stands
for k pairwise ones; the runs of `fan` neighbours meet, dealt by digest, sorted, and are merged multiway. Each level
keeps the best identifier of a digest and adds the counts. A merge joins two entries only if SHA-256, length and a second,
independent 64-bit hash of the text all agree. A group of any size has one entry in a partition's run, so no task ever gets
more than `fan` entries of one digest; the winners go back to the rows the same way, by partition and digest.

Texts are compared after lower-casing A-Z only. A null text counts as empty; empty texts are equal. Repeated rows
(same id) all count; all rows with the winning id are kept. A null id loses to any other. Extra columns don't
matter: only the id and the text are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bandsieve.llm._shared import column_bytes, materialize, releasing, small_batches, tidy


def digests(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """id, part (the partition that read the row), digest, check2, n_bytes of each row's normalised text."""
    id_type = docs.schema[id_col].dataType.simpleString()

    @releasing
    def hashed(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            texts = [(x or b"").lower() for x in column_bytes(part, "text")]
            second = np.fromiter(map(xxhash.xxh3_64_intdigest, texts), np.uint64, len(texts)).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [part.column("id"), part.column("part"), pa.array([hashlib.sha256(x).digest() for x in texts], pa.binary()), pa.array(second), pa.array(list(map(len, texts)), pa.int64())],
                names=["id", "part", "digest", "check2", "n_bytes"],
            )

    return docs.select(F.col(id_col).alias("id"), F.spark_partition_id().alias("part"), F.col(text_col).alias("text")).mapInArrow(hashed, f"id {id_type}, part int, digest binary, check2 long, n_bytes long")


def _merge(keep: str):
    """Merges the sorted runs in a partition into one sorted run; equal digests, verified, become one entry."""

    @releasing
    def merged(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, best, n = None, None, 0
        out: list[tuple] = []
        schema = None

        def flush() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)

        for part in parts:  # sorted by key: runs arrive merged by the shuffle's sort
            schema = part.schema
            for r_cell, r_digest, r_check, r_bytes, r_best, r_n in zip(*(part.column(i).to_pylist() for i in range(6))):
                at = (r_cell, r_digest, r_check, r_bytes)
                if at == key:
                    n += r_n
                    if best is None or r_best is not None and (r_best > best if keep == "largest" else r_best < best):
                        best = r_best
                    continue
                if key is not None:
                    out.append((*key, best, n))
                    if len(out) >= 20_000:
                        yield flush()
                        out = []
                key, best, n = at, r_best, r_n
        if key is not None:
            out.append((*key, best, n))
        if out:
            yield flush()

    return merged


KEY = ["digest", "check2", "n_bytes"]


def merge_runs(runs: DataFrame, fan: int, partitions: int, keep: str) -> DataFrame:
    """One round: runs of `fan` neighbouring cells are exchanged by digest and merged."""
    id_type = runs.schema["best"].dataType.simpleString()
    cells = runs.withColumn("cell", F.floor(F.col("cell") / fan).cast("int"))
    exchanged = cells.select("cell", *KEY, "best", "n").repartition(partitions, "cell", "digest").sortWithinPartitions("cell", *KEY)
    return exchanged.mapInArrow(_merge(keep), f"cell int, digest binary, check2 long, n_bytes long, best {id_type}, n long")


@tidy
def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "smallest", fan: int = 16) -> DataFrame:
    """Columns: the id, keep_id, group_size, kept, digest (binary SHA-256 of the normalised text). One row per row of docs."""
    spark = docs.sparkSession
    small_batches(spark)
    rows = materialize(digests(docs, id_col, text_col))
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # The leaves: each reading partition's own run, combined where the rows are before anything is sent.
    best = F.max("id") if keep == "largest" else F.min("id")
    leaves = materialize(rows.groupBy(F.col("part").alias("cell"), *KEY).agg(best.alias("best"), F.count(F.lit(1)).alias("n")))
    cells = (leaves.agg(F.max("cell")).first()[0] or 0) + 1
    top = leaves
    while cells > 1:
        top, cells = merge_runs(top, fan, partitions, keep), -(-cells // fan)
    won = top.select(*KEY, F.col("best").alias("keep_id"), F.col("n").alias("group_size"))
    # Back down: every leaf entry learns its digest's winner, then every row its leaf entry's.
    down = leaves.select(F.col("cell").alias("part"), *KEY).join(won, KEY)
    out = rows.join(down, ["part", *KEY])
    return out.select(F.col("id").alias(id_col), "keep_id", "group_size", F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"), "digest")
