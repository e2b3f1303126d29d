"""Dimension files: the id mapping and the calendar of named periods, always
read with their own schema (ids stay strings)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

MAPPING_CSV = "raw_station_id string, canonical_station_id string"
CALENDAR_CSV = "start_date date, end_date date, event_name string"


def _read(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).option("header", True).option("enforceSchema", False).option("mode", "FAILFAST").csv(path)


def read_id_mapping(spark: SparkSession, path: str) -> DataFrame:
    return _read(spark, path, MAPPING_CSV)


def read_event_calendar(spark: SparkSession, path: str) -> DataFrame:
    return _read(spark, path, CALENDAR_CSV)
