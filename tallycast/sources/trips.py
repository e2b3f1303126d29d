"""Trip-file ingestion: file listing, month keys, incremental selection,
strict typed CSV parsing (also from zip archives) and per-month sinks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import TRIP_COLUMNS, TRIPS_CSV, check_columns
from . import archives
from .paths import has_data

# Tokens read as null, the raw timestamp format, the file-name pattern.
NULL_TOKENS = ["", "NULL", "null"]
TS_FORMAT = "yyyy-MM-dd HH:mm:ss"
KEY_PATTERN = r"^(\d{4})(\d{2})-.*\.zip$"


def month_from_key(name: Column) -> Column:
    """'YYYYMM-...zip' (base name) -> 'YYYY-MM', anything else -> null."""
    base = F.regexp_extract(name, r"([^/]*)$", 1)
    y = F.regexp_extract(base, KEY_PATTERN, 1)
    m = F.regexp_extract(base, KEY_PATTERN, 2)
    return F.when(base.rlike(KEY_PATTERN), F.concat(y, F.lit("-"), m))


def list_files(spark: SparkSession, landing: str, glob: str = "*.zip") -> DataFrame:
    """File listing as a DataFrame (``content`` is never read)."""
    return (spark.read.format("binaryFile").option("pathGlobFilter", glob).load(landing)
            .select("path", "length", "modificationTime"))


def months_in_range(files: DataFrame, start: str, end: str) -> DataFrame:
    return (files.withColumn("month", month_from_key(F.col("path")))
            .where(F.col("month").isNotNull() & F.col("month").between(start, end)))


def incremental_months(available: DataFrame, stored: DataFrame) -> DataFrame:
    """Months available but not yet stored (anti join), sorted."""
    return available.select("month").distinct().join(stored.select("month").distinct(), "month", "left_anti").orderBy("month")


def _null_tokens(c: Column) -> Column:
    return F.when(c.isin(*NULL_TOKENS) | c.isNull(), F.lit(None).cast("string")).otherwise(c)


def parse_trips(raw: DataFrame) -> DataFrame:
    """String columns -> typed trips. Ids stay strings; fractional seconds are
    stripped; a malformed timestamp fails the job (ANSI ``to_timestamp_ntz``)."""
    check_columns(raw.columns, TRIP_COLUMNS, "trips")
    out = []
    for f in TRIPS_CSV.fields:
        c = _null_tokens(F.col(f.name).cast("string"))
        if f.name in ("started_at", "ended_at"):
            c = F.to_timestamp_ntz(F.regexp_replace(c, r"\.\d+$", ""), F.lit(TS_FORMAT))
        elif f.dataType.typeName() == "double":
            c = c.cast("double")
        out.append(c.alias(f.name))
    return raw.select(*out)


def read_trip_csv(spark: SparkSession, path: str) -> DataFrame:
    """Typed read of landed CSV files, in sub-folders too (folder names add no
    columns); the header must match the contract."""
    raw = spark.read.option("recursiveFileLookup", True).option("header", True).option("enforceSchema", False).schema(_all_strings()).csv(path)
    return parse_trips(raw)


def _all_strings():
    from pyspark.sql import types as T
    return T.StructType([T.StructField(c, T.StringType(), True) for c in TRIP_COLUMNS])


def read_trip_zips(spark: SparkSession, path: str, glob: str = "*.zip") -> DataFrame:
    """Zipped monthly trip files -> typed trips: every root-level CSV member is
    inflated as a stream by a task of its own, whatever the archive's size."""
    return parse_trips(archives.read_members(archives.list_members(spark, path, glob), TRIP_COLUMNS, check_columns))


def write_by_month(trips: DataFrame, path: str) -> None:
    """One Parquet partition per month; re-writing a month replaces only it."""
    (trips.withColumn("month", F.date_format("started_at", "yyyy-MM")).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy("month").parquet(path))


def stored_months(spark: SparkSession, path: str) -> DataFrame:
    if not has_data(spark, path):
        return spark.createDataFrame([], "month string")
    return spark.read.parquet(path).select("month").distinct()
