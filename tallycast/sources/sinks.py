"""Data-product sinks: Parquet (optionally partitioned), CSV with header and
one-record JSON documents (decisions, summaries, metadata)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_parquet(df: DataFrame, path: str, partition_by: list[str] | None = None, mode: str = "overwrite") -> None:
    w = df.write.mode(mode)
    if partition_by:
        w = w.option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by)
    w.parquet(path)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).option("header", True).csv(path)


def write_record(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """A one-row result (nested structs/arrays allowed) as a JSON document."""
    df.coalesce(1).write.mode(mode).json(path)


def write_product(df: DataFrame, root: str, name: str, ts: str = "hour") -> str:
    """A named data product, one partition per calendar month of ``ts``; months
    that ``df`` holds are replaced, others stay. Returns its path."""
    path = f"{root.rstrip('/')}/{name}"
    write_parquet(df.withColumn("_month", F.date_format(ts, "yyyy-MM")), path, ["_month"])
    return path


def read_product(spark: SparkSession, root: str, name: str, months: list[str] | None = None) -> DataFrame:
    """A named product, or the given months of it: only their folders are read."""
    df = spark.read.parquet(f"{root.rstrip('/')}/{name}")
    return (df if months is None else df.where(F.col("_month").isin(months))).drop("_month")
