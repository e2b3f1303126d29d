"""Whether something is stored at a path, asked of the path's own file system
before a read, so that no read error is ever taken for "nothing stored"."""

from __future__ import annotations

from pyspark.sql import SparkSession


def matches(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that a glob pattern matches; empty when there is none."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(pattern)
    fs = path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    return [s.getPath().toString() for s in (fs.globStatus(path) or [])]


def has_data(spark: SparkSession, folder: str) -> bool:
    """A folder exists and holds anything besides hidden or bookkeeping entries."""
    return any(not p.rsplit("/", 1)[-1].startswith(("_", ".")) for p in matches(spark, f"{folder}/*"))
