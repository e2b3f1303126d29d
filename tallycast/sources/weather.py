"""Covariate payloads (an object of parallel hourly arrays) -> rows, month
bounds and skip-if-exists sinks. The HTTP fetch itself is not part of the
library: payload files are expected to have landed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import WEATHER_COLUMNS, check_columns

VARS = WEATHER_COLUMNS[1:]


def payload_to_rows(payloads: DataFrame) -> DataFrame:
    """Each row holds one payload with an ``hourly`` struct of arrays (``time`` +
    variables, no others, equally long). Output: the weather contract, in order."""
    if "hourly" not in payloads.columns:
        raise ValueError("payload has no 'hourly' block")
    check_columns(payloads.schema["hourly"].dataType.fieldNames(), ["time", *VARS], "payload", ordered=False)
    h = F.col("hourly")
    sizes = F.array_distinct(F.array(*[F.size(h.getField(v)) for v in ("time", *VARS)]))
    h = F.when(F.size(sizes) == 1, h).otherwise(F.raise_error(F.concat(F.lit("payload arrays differ in length: "), sizes.cast("string"))))
    zipped = F.arrays_zip(h.getField("time").alias("time"), *[h.getField(v).alias(v) for v in VARS])
    rows = payloads.select(F.inline(zipped))
    return rows.select(F.to_timestamp_ntz(F.col("time"), F.lit("yyyy-MM-dd'T'HH:mm")).alias("timestamp"),
                       *[F.col(v).cast("double").alias(v) for v in VARS])


def read_payloads(spark: SparkSession, path: str, multiline: bool = True) -> DataFrame:
    """One payload document per file (``multiline``) or one per line."""
    return payload_to_rows(spark.read.option("multiLine", multiline).json(path))


def month_bounds(month: Column) -> tuple[Column, Column]:
    """'YYYY-MM' -> first and last day (leap years included)."""
    first = F.to_date(F.concat(month, F.lit("-01")))
    return first, F.last_day(first)


def ingest(df: DataFrame, path: str, force: bool = False) -> None:
    """Existing output is kept unless ``force`` (same schema in both modes)."""
    df.write.mode("overwrite" if force else "ignore").parquet(path)


def assert_unique_time(weather: DataFrame, col: str = "timestamp") -> None:
    """Overlapping payload files would duplicate hours and multiply joined rows."""
    dup = weather.groupBy(col).count().where("count > 1").limit(1).count()
    if dup:
        raise ValueError("covariate table has duplicate timestamps")
