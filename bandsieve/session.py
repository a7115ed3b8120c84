"""Sessions, and how this package reaches Python workers."""

from __future__ import annotations

import atexit
import shutil
import tempfile
from pathlib import Path

from pyspark.sql import SparkSession

ROOT = str(Path(__file__).resolve().parent.parent)


def ship(spark: SparkSession) -> SparkSession:
    """Lets Python workers import this package from where the driver has it (no effect where it is installed)."""
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(":") if p]
    if ROOT not in paths:
        env["PYTHONPATH"] = ":".join([ROOT, *paths])
    return spark


_own_folder: list[str] = []


def shared_base(spark: SparkSession) -> str:
    """The folder that the driver and all executors share, from spark.checkpoint.dir.

    Where that is unset, a session on one machine gets a temporary folder, removed when Python ends; any other raises."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        return base.rstrip("/")
    master = spark.sparkContext.master
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if not _own_folder:
        _own_folder.append(tempfile.mkdtemp(prefix="bandsieve-"))
        atexit.register(shutil.rmtree, _own_folder[0], ignore_errors=True)
    return f"file://{_own_folder[0]}"


def remove_folder(spark: SparkSession, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def cluster_session(**more: str) -> SparkSession:
    """The session that spark-submit or the environment configures, or one on this machine if there is no master."""
    builder = SparkSession.builder.appName("bandsieve")
    for key, value in more.items():
        builder = builder.config(key.replace("__", "."), str(value))
    return ship(builder.getOrCreate())


def local_session(cores: int | str = 8, partitions: int = 8, memory: str = "8g", **more: str) -> SparkSession:
    """A session for tests and benchmarks on one machine; further settings as keywords, with __ for dots."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName("bandsieve")
    conf = {
        "spark.sql.shuffle.partitions": partitions,
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": memory,
        "spark.driver.host": "127.0.0.1",
    } | {k.replace("__", "."): v for k, v in more.items()}
    for key, value in conf.items():
        builder = builder.config(key, str(value))
    return ship(builder.getOrCreate())
