"""Trip cleaning: survival rules, removal report, canonical series keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import Config
from ..functions.exprs import all_of, duration_seconds


def survival_rules(cfg: Config, key: str = "start_station_id") -> dict[str, Column]:
    """Rule name -> survival predicate (shared by report and filter)."""
    d = duration_seconds()
    return {
        "missing_station": F.col(key).isNotNull(),
        "too_short_or_negative": d >= cfg.min_trip_seconds,
        "too_long": d <= cfg.max_trip_hours * 3600,
    }


def removal_report(trips: DataFrame, cfg: Config) -> DataFrame:
    """One row: total and violations per rule in one pass. Rules overlap; a
    null predicate is not counted as a violation."""
    rules = survival_rules(cfg)
    return trips.agg(F.count(F.lit(1)).alias("total"),
                     *[F.count_if(~rule).alias(name) for name, rule in rules.items()])


def clean_trips(trips: DataFrame, cfg: Config, mapping: DataFrame | None = None,
                guard: bool = True) -> DataFrame:
    """Apply all survival rules and map raw keys to canonical ones
    (``station_id = coalesce(canonical, raw)``)."""
    out = trips.filter(all_of(survival_rules(cfg).values()))
    if mapping is None:
        return out.withColumn("station_id", F.col("start_station_id"))
    m = mapping.select("raw_station_id", "canonical_station_id")
    if guard:
        # duplicate raw keys would multiply rows
        st = m.agg(F.count(F.lit(1)).alias("n"), F.count_distinct("raw_station_id").alias("k")).first()
        if st["n"] != st["k"]:
            raise ValueError("station mapping: duplicate raw_station_id values would multiply joined rows")
    return (out.join(m, out["start_station_id"] == m["raw_station_id"], "left")
            .withColumn("station_id", F.coalesce(F.col("canonical_station_id"), F.col("start_station_id")))
            .drop("raw_station_id", "canonical_station_id"))
