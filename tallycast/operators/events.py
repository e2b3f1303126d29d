"""Named-period (event calendar) feature: range calendar -> one row per day -> flag."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from ..functions.exprs import month_str


def event_days(calendar: DataFrame) -> DataFrame:
    """Expand (start_date, end_date, event_name) ranges to one row per date and
    keep the first event per date (by start date, then name)."""
    days = calendar.select(F.explode(F.sequence("start_date", "end_date")).alias("date"),
                           "event_name", "start_date")
    w = Window.partitionBy("date").orderBy("start_date", "event_name")
    return (days.withColumn("_rn", F.row_number().over(w)).where("_rn = 1")
            .select("date", "event_name"))


def add_event_feature(df: DataFrame, days: DataFrame, ts: str = "hour") -> DataFrame:
    """is_major_event 0/1 by a left join on date; the planner chooses the join.
    A date listed twice is an error, as it would multiply rows (``event_days``
    lists each once)."""
    twice = days.groupBy("date").agg(F.count(F.lit(1)).alias("n")).where("n > 1").limit(5).collect()
    if twice:
        raise ValueError(f"event days list {[str(r[0]) for r in twice]} more than once")
    d = days.select(F.col("date").alias("_event_date"), "event_name")
    return (df.withColumn("_event_date", F.to_date(ts)).join(d, "_event_date", "left")
            .withColumn("is_major_event", F.col("event_name").isNotNull().cast("int"))
            .drop("_event_date", "event_name"))


def event_coverage(df: DataFrame, ts: str = "hour") -> DataFrame:
    """Flagged rows, rows and flagged share per month."""
    return (df.groupBy(month_str(ts).alias("month"))
            .agg(F.sum("is_major_event").cast("bigint").alias("event_rows"),
                 F.count(F.lit(1)).alias("rows"))
            .withColumn("event_share", F.col("event_rows") / F.col("rows")))
