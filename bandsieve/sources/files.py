"""Catalog, gold set, bands, rubric, snapshot, vectors and listings: what is read from files."""

from __future__ import annotations

import json
import re
import xml.etree.ElementTree as ET
from collections.abc import Mapping
from pathlib import PurePosixPath
from typing import Any

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from bandsieve.functions.bands import DEFAULT_BANDS, overlay
from bandsieve.schema import GOLD, RUBRIC
from bandsieve.sources.store import exists


def read_text(spark: SparkSession, path: str) -> str | None:
    """A small file's text by Spark's readers, None if it isn't there."""
    try:
        rows = spark.read.text(path, wholetext=True).collect()
    except Exception:  # noqa: BLE001
        return None
    return rows[0][0] if rows else ""


def catalog(spark: SparkSession, root: str, pattern: str = "*.mp4", top: str = "processed_v3", now: float = 0.0) -> DataFrame:
    """videos of the files below root/top: path (from top on), embodiment (the folder below top), hash (the stem). Contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(f"{root.rstrip('/')}/{top}").select("path")
    path = F.concat(F.lit(f"{top}/"), F.element_at(F.split("path", f"/{top}/"), -1))
    return files.select(
        path.alias("path"),
        F.element_at(F.split(path, "/"), 2).alias("embodiment"),
        F.regexp_replace(F.element_at(F.split(path, "/"), -1), r"\.[^.]*$", "").alias("hash"),
        F.lit(None).cast("int").alias("n_frames"),
        F.lit(now).alias("added_at"),
    )


def gold(spark: SparkSession, path: str) -> DataFrame:
    """The gold set's JSON lines; blank lines are skipped, and the last line of a video wins."""
    lines = spark.read.text(path, wholetext=True).select(F.posexplode(F.split("value", "\n")).alias("line", "text")).filter(F.trim("text") != "")
    rows = lines.select("line", F.from_json("text", GOLD).alias("g")).select("line", "g.*")
    last = Window.partitionBy("video").orderBy(F.desc("line"))
    return rows.withColumn("r", F.row_number().over(last)).filter("r = 1").select("video", "reasons", "_vlm")


def load_bands(spark: SparkSession, path: str) -> dict[str, tuple[float, float]]:
    """The shipped bands with a file's over them; a missing or malformed file changes nothing."""
    text = read_text(spark, path)
    try:
        return overlay({k: (float(v[0]), float(v[1])) for k, v in json.loads(text or "{}").items()})
    except (ValueError, TypeError, AttributeError, IndexError, KeyError):
        return dict(DEFAULT_BANDS)


def save_bands(path: str, posted: Mapping[str, tuple[float, float]], live: Mapping[str, tuple[float, float]] = DEFAULT_BANDS) -> dict[str, tuple[float, float]]:
    """Writes the live bands with posted ones over them, on the driver."""
    from pyarrow import fs

    bands = overlay(posted, live)
    where, at = fs.FileSystem.from_uri(path if "://" in path else f"file://{path}")
    with where.open_output_stream(at) as f:
        f.write(json.dumps({k: list(v) for k, v in bands.items()}, indent=1).encode())
    return bands


def rubric(spark: SparkSession, path: str) -> DataFrame:
    """One row an item: task, scene, id, label, desc, fail_if, borderline."""
    rows = spark.read.schema(RUBRIC).option("multiLine", True).json(path)
    return rows.select("task", "scene", F.posexplode("items").alias("ord", "item")).select("task", "scene", "ord", "item.*")


def snapshot(spark: SparkSession, path: str) -> dict[str, Any]:
    return json.loads(read_text(spark, path) or "{}")


def vectors(spark: SparkSession, path: str, encoder: str) -> DataFrame:
    """id and normalised vector of one encoder, from the Parquet vector store; rows without a vector are left out."""
    rows = spark.read.parquet(path).filter((F.col("encoder") == encoder) & (F.size("pooled") > 0))
    norm = F.sqrt(F.aggregate("pooled", F.lit(0.0), lambda a, x: a + x.cast("double") * x)) + 1e-8
    return rows.select("id", F.transform("pooled", lambda x: x.cast("double") / norm).alias("vector"))


def save_vectors(rows: DataFrame, path: str) -> None:
    rows.write.mode("append").partitionBy("encoder").parquet(path)


def parse_listing(page: str) -> tuple[list[tuple[str, int]], list[str], str | None]:
    """Keys with sizes, common prefixes and the continuation token of one page of an object store's XML listing."""
    root = ET.fromstring(page)
    for x in root.iter():
        x.tag = x.tag.rpartition("}")[2]
    keys = [(c.findtext("Key", ""), int(c.findtext("Size", "0"))) for c in root.iter("Contents")]
    prefixes = [p.findtext("Prefix", "") for p in root.iter("CommonPrefixes")]
    return keys, prefixes, root.findtext("NextContinuationToken") if root.findtext("IsTruncated") == "true" else None


def listing(spark: SparkSession, fetch, roots: list[str], suffix: str = ".mp4", skip: str = ".zarr") -> DataFrame:  # noqa: ANN001
    """key and size of the objects under the roots. fetch(prefix, delimiter, token) gives a page's XML; it runs in tasks, one for
    each second-level prefix; prefixes that end in `skip` are left out."""

    def pages(prefix: str, delimiter: str):  # noqa: ANN202
        token = None
        while True:
            keys, prefixes, token = parse_listing(fetch(prefix, delimiter, token))
            yield keys, prefixes
            if token is None:
                return

    def below(prefix: str) -> list[str]:
        return [p for _, prefixes in pages(prefix, "/") for p in prefixes if not p.rstrip("/").endswith(skip)]

    second = [(p,) for root in roots for p in below(root)]

    def load(parts):  # noqa: ANN001, ANN202
        import pandas as pd

        for part in parts:
            for prefix in part["prefix"]:
                for keys, _ in pages(prefix, ""):
                    yield pd.DataFrame([k for k in keys if k[0].endswith(suffix)], columns=["key", "size"])

    return spark.createDataFrame(second or [], "prefix string").repartition(max(1, len(second))).mapInPandas(load, "key string, size long")


def prefix_sizes(listed: DataFrame, key: str = "key", size: str = "size") -> DataFrame:
    """Objects and bytes by first part of the key, largest first."""
    return listed.groupBy(F.element_at(F.split(key, "/"), 1).alias("prefix")).agg(F.count(F.lit(1)).alias("objects"), F.sum(size).alias("bytes")).orderBy(F.desc("bytes"), "prefix")


def missing_objects(listed: DataFrame, local: DataFrame) -> DataFrame:
    """Objects that aren't here yet or are empty here: what a download has to fetch."""
    return listed.join(local.filter("size > 0").select("key"), "key", "left_anti")


def download(spark: SparkSession, fetch, listed: DataFrame, local: DataFrame, folder: str) -> tuple[int, int]:  # noqa: ANN001
    """Fetches what is missing or empty here into a folder that executors can write to; gives the numbers fetched and still missing.

    fetch(key) gives an object's bytes; it runs in tasks, and an object that fails stays missing for the next call."""

    def get(parts):  # noqa: ANN001, ANN202
        import pandas as pd
        from pyarrow import fs

        where, root = fs.FileSystem.from_uri(folder)
        for part in parts:
            sizes = []
            for key in part["key"]:
                try:
                    data = fetch(key)
                    where.create_dir(f"{root}/{key}".rpartition("/")[0], recursive=True)
                    with where.open_output_stream(f"{root}/{key}") as f:
                        f.write(data)
                    sizes.append(len(data))
                except Exception:  # noqa: BLE001
                    sizes.append(0)
            yield pd.DataFrame({"key": part["key"], "size": sizes})

    todo = missing_objects(listed, local).select("key")
    got = todo.repartition("key").mapInPandas(get, "key string, size long").agg(F.count_if(F.col("size") > 0).alias("got"), F.count_if(F.col("size") == 0).alias("left")).first()
    return int(got["got"]), int(got["left"])


def local_objects(spark: SparkSession, folder: str) -> DataFrame:
    """key (below the folder) and size of the files that are here; none where the folder isn't there yet."""
    if not exists(spark, folder):
        return spark.createDataFrame([], "key string, size long")
    rows = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder).select("path", "length")
    root = folder.partition("://")[2] if "://" in folder else folder
    return rows.select(F.regexp_replace("path", "^.*" + re.escape(root.rstrip("/")) + "/", "").alias("key"), F.col("length").alias("size"))


def file_digests(spark: SparkSession, path: str) -> DataFrame:
    """path and sha256 (lowercase hex) of the files under a path."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path", F.sha2("content", 256).alias("sha256"))


def stem(path: str) -> str:
    return PurePosixPath(path).stem
