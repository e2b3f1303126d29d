"""Incremental file ingestion as a stream: landed trip CSV files -> typed
trips -> Parquet partitioned by month. ``trigger(availableNow=True)`` reads
only files the checkpoint has not recorded yet and then stops, so re-running
after new files land appends just those files (exactly once per file)."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from ..sources.trips import _all_strings, parse_trips


def ingest_trip_files(spark: SparkSession, landing: str, out: str, checkpoint: str, fmt: str = "csv") -> None:
    raw = (spark.readStream.schema(_all_strings()).option("header", True).option("enforceSchema", False)
           .format(fmt).load(landing))
    typed = parse_trips(raw).withColumn("month", F.date_format("started_at", "yyyy-MM"))
    q = (typed.writeStream.format("parquet").option("checkpointLocation", checkpoint).option("path", out)
         .partitionBy("month").outputMode("append").trigger(availableNow=True).start())
    q.awaitTermination()
