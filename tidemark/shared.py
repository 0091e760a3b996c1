"""The folder that driver and executors share, and names that clash with no column."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterable

from pyspark.sql import SparkSession


def hadoop_path(spark: SparkSession, path: str):
    """(file system, path) of a path on any store that Spark reaches."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def shared_dir(spark: SparkSession) -> str:
    """A new folder under ``spark.checkpoint.dir``, gone at the session's end; a local one only where nothing is set
    on a local master, as in tests."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = f"file://{tempfile.gettempdir()}/tidemark-stage"
    path = f"{base.rstrip('/')}/tidemark-{uuid.uuid4().hex}"
    fs, target = hadoop_path(spark, path)
    fs.mkdirs(target)
    fs.deleteOnExit(target)
    return path


def free_name(taken: Iterable[str], wanted: str) -> str:
    """``wanted``, lengthened until no column is called so (names differ by more than case)."""
    taken = {c.lower() for c in taken}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted
