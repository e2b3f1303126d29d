"""Exploratory profiles as tables: overview, monthly demand, data quality,
duration histogram, demand shapes, covariate effects, zero inflation,
volume concentration and the time-shift sanity check."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from ..functions.exprs import materialize
from ..functions.calendar import iso_dow
from ..functions.exprs import bucket, duration_seconds, month_str


def raw_overview(trips: DataFrame) -> DataFrame:
    return trips.agg(F.count(F.lit(1)).alias("total_trips"), F.min("started_at").alias("min_started_at"),
                     F.max("started_at").alias("max_started_at"),
                     F.count_distinct("start_station_id").alias("n_start_station_ids"),
                     F.count_distinct("end_station_id").alias("n_end_station_ids"))


def clean_overview(clean: DataFrame) -> DataFrame:
    return clean.agg(F.count(F.lit(1)).alias("clean_trips"),
                     F.count_distinct("start_station_id").alias("clean_start_station_ids"))


def monthly_demand(trips: DataFrame) -> DataFrame:
    return trips.groupBy(month_str("started_at").alias("month")).agg(F.count(F.lit(1)).alias("trips"))


def peak_and_low_month(trips: DataFrame) -> DataFrame:
    """Busiest and quietest month (ties -> earliest month), in one pass over the
    per-month table."""
    top = F.min(F.struct((-F.col("trips")).alias("n"), "month"))
    low = F.min(F.struct(F.col("trips").alias("n"), "month"))
    return (monthly_demand(trips).agg(top.alias("top"), low.alias("low"), F.count(F.lit(1)).alias("months"))
            .select(F.col("top.month").alias("peak_month"), (-F.col("top.n")).alias("peak_trips"),
                    F.col("low.month").alias("low_month"), F.col("low.n").alias("low_trips"), "months"))


def quality_summary(trips: DataFrame, min_seconds: int = 60, max_hours: int = 24) -> DataFrame:
    """Five rule counts and their share of all rows, in long format."""
    d = duration_seconds()
    wide = trips.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(d < min_seconds).alias("r1"), F.count_if(d > max_hours * 3600).alias("r2"),
        F.count_if(F.col("start_station_id").isNull()).alias("r3"),
        F.count_if(F.col("end_station_id").isNull()).alias("r4"),
        F.count_if(F.col("started_at") > F.col("ended_at")).alias("r5"))
    # fixed values: rule names of the published summary
    labels = [f"duration < {min_seconds}s", f"duration > {max_hours}h", "missing start_station_id",
              "missing end_station_id", "started_at > ended_at"]
    stack = "stack(5, " + ", ".join(f"'{lab}', r{i + 1}" for i, lab in enumerate(labels)) + ") as (rule, rows)"
    return (wide.selectExpr("total", stack)
            .withColumn("pct", F.col("rows") / F.col("total") * 100).drop("total"))


def duration_histogram(trips: DataFrame, max_seconds: int = 7200, bins: int = 100) -> DataFrame:
    """Counts of durations in [0, max_seconds] in equal-width bins (last bin closed)."""
    d = duration_seconds()
    width = max_seconds / bins
    b = F.least(F.floor(d / F.lit(width)), F.lit(bins - 1)).cast("int")
    return (trips.where(d.between(0, max_seconds)).groupBy(b.alias("bin")).agg(F.count(F.lit(1)).alias("trips"))
            .withColumn("lo_seconds", F.col("bin") * F.lit(width))
            .withColumn("hi_seconds", (F.col("bin") + 1) * F.lit(width)))


def hourly_profile(clean: DataFrame) -> DataFrame:
    return (clean.groupBy(F.hour("started_at").cast("int").alias("hour"),
                          (iso_dow(F.col("started_at")) >= 6).alias("is_weekend"))
            .agg(F.count(F.lit(1)).alias("trips")))


def weekday_hour(clean: DataFrame) -> DataFrame:
    return (clean.groupBy(iso_dow(F.col("started_at")).alias("weekday"), F.hour("started_at").cast("int").alias("hour"))
            .agg(F.count(F.lit(1)).alias("trips")))


def weekday_hour_pivot(clean: DataFrame) -> DataFrame:
    """Weekday x hour heat table: one row per weekday, columns h0..h23."""
    base = clean.select(iso_dow(F.col("started_at")).alias("weekday"), F.hour("started_at").cast("int").alias("_h"))
    p = base.groupBy("weekday").pivot("_h", list(range(24))).agg(F.count(F.lit(1)))
    return p.select("weekday", *[F.coalesce(F.col(str(h)), F.lit(0)).cast("bigint").alias(f"h{h}") for h in range(24)])


def type_hourly(clean: DataFrame) -> DataFrame:
    return (clean.groupBy(F.hour("started_at").cast("int").alias("hour"), "member_casual")
            .agg(F.count(F.lit(1)).alias("trips")))


def system_hourly(clean: DataFrame) -> DataFrame:
    return clean.groupBy(bucket("started_at", "hour").alias("timestamp")).agg(F.count(F.lit(1)).alias("trips"))


def system_with_covariates(clean: DataFrame, covariates: DataFrame) -> DataFrame:
    return system_hourly(clean).join(covariates, "timestamp", "inner")


def system_match_rate(clean: DataFrame, covariates: DataFrame) -> DataFrame:
    s = system_hourly(clean)
    j = s.join(covariates.select("timestamp", F.lit(1).alias("_m")), "timestamp", "left")
    return (j.agg(F.count(F.lit(1)).alias("hours"), F.count("_m").alias("matched"))
            .withColumn("match_rate", F.col("matched") / F.col("hours"))
            .withColumn("passed", F.col("match_rate") >= 0.95))


def mean_by_hour_of_day(clean: DataFrame) -> DataFrame:
    return (system_hourly(clean).groupBy(F.hour("timestamp").cast("int").alias("hour"))
            .agg(F.avg("trips").alias("avg_trips")))


def temperature_bins(sw: DataFrame, width: float = 5.0, min_hours: int = 20) -> DataFrame:
    return (sw.groupBy((F.floor(F.col("temperature_2m") / width) * width).cast("double").alias("temp_bin_c"))
            .agg(F.avg("trips").alias("avg_trips_per_hour"), F.count(F.lit(1)).alias("hours"))
            .where(F.col("hours") >= min_hours))


def flag_effect(sw: DataFrame, flag, name: str) -> DataFrame:
    """Mean demand by a boolean covariate flag and the reduction vs. the false group."""
    g = sw.groupBy(flag.alias(name)).agg(F.avg("trips").alias("avg_trips_per_hour"),
                                         F.count(F.lit(1)).alias("hours"))
    dry = g.where(~F.col(name)).select("avg_trips_per_hour").scalar()
    return g.withColumn("reduction_pct", (1 - F.try_divide(F.col("avg_trips_per_hour"), dry)) * 100)


def rain_effect(sw: DataFrame, threshold: float = 0.5) -> DataFrame:
    return flag_effect(sw, F.col("precipitation") > threshold, "rainy_hour")


def snow_effect(sw: DataFrame) -> DataFrame:
    return flag_effect(sw, F.col("snowfall") > 0, "snowy_hour")


def zero_inflation(grid: DataFrame, by_month: bool = False) -> DataFrame:
    keys = [month_str("hour").alias("month")] if by_month else []
    return grid.groupBy(*keys).agg(F.count(F.lit(1)).alias("station_hours"),
                                   F.avg((F.col("trips") == 0).cast("double")).alias("zero_share"),
                                   F.avg("trips").alias("avg_trips"))


def distributed_rank(df: DataFrame, order: list, value: str, partitions: int | None = None) -> DataFrame:
    """Global rank 1..n and running sum of ``value`` in ``order`` without a
    single-partition window: range-partition by the order, rank and sum
    within each partition, then add the offsets of all earlier partitions
    (a table with one row per partition)."""
    spark = df.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    # written once: the partition id must be the same in both uses below
    ranged = materialize(df.repartitionByRange(n, *order).withColumn("_pid", F.spark_partition_id()), "table")
    local = Window.partitionBy("_pid").orderBy(*order)
    ranked = (ranged.withColumn("_rn", F.row_number().over(local))
              .withColumn("_cs", F.sum(value).over(local.rowsBetween(Window.unboundedPreceding, 0))))
    totals = ranged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"), F.sum(value).alias("_s"))
    w = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)  # one row per partition
    offsets = totals.select("_pid", F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_off_n"),
                            F.coalesce(F.sum("_s").over(w), F.lit(0)).alias("_off_s"))
    return (ranked.join(F.broadcast(offsets), "_pid")
            .withColumn("rank", (F.col("_off_n") + F.col("_rn")).cast("int"))
            .withColumn("running", F.col("_off_s") + F.col("_cs"))
            .drop("_pid", "_rn", "_cs", "_off_n", "_off_s"))


def volume_ranking(clean: DataFrame, lookback_days: int = 365, key: str = "station_id") -> DataFrame:
    """Per key volume in the lookback, rank 1..n by volume (ties by key) and
    cumulative share, ranked with ``distributed_rank`` (no single-task window)."""
    cutoff = clean.select(F.timestamp_add("DAY", F.lit(-lookback_days), F.max("started_at"))).scalar()
    vol = clean.where(F.col("started_at") >= cutoff).groupBy(key).agg(F.count(F.lit(1)).alias("trips"))
    total = vol.agg(F.sum("trips")).scalar()
    r = distributed_rank(vol, [F.desc("trips"), F.asc(key)], "trips")
    return r.withColumn("cum_share", F.col("running") / total).drop("running")


def share_at_and_rank_for(ranking: DataFrame, target: float = 0.65, ns=(100, 150, 200, 250, 300)) -> DataFrame:
    """Share held by the top n (for each n present) and the smallest n reaching ``target``."""
    reach = ranking.where(F.col("cum_share") >= target).agg(F.min("rank")).scalar()
    return (ranking.where(F.col("rank").isin(list(ns))).select(F.col("rank").alias("top_n"), "cum_share")
            .withColumn("rank_for_target", reach).withColumn("target", F.lit(target)))


def shift_sanity(clean: DataFrame, peak_hours=(16, 17, 18), morning: int = 8, night: int = 3) -> DataFrame:
    """Weekday peak hour in the commute window and morning > 3 x night, in one
    pass over the hourly profile."""
    wk = hourly_profile(clean).where(~F.col("is_weekend"))
    at = lambda h: F.coalesce(F.max(F.when(F.col("hour") == h, F.col("trips"))), F.lit(0))
    top = F.min(F.struct((-F.col("trips")).alias("n"), F.col("hour").alias("hour")))
    return (wk.agg(F.count(F.lit(1)).alias("hours_present"), top.alias("_top"), at(morning).alias("morning_trips"), at(night).alias("night_trips"))
            .select(F.col("_top.hour").alias("peak_hour"), "morning_trips", "night_trips", "hours_present")
            .withColumn("peak_ok", F.col("peak_hour").isin(list(peak_hours)))
            .withColumn("morning_ok", F.col("morning_trips") > 3 * F.col("night_trips"))
            .withColumn("passed", F.col("peak_ok") & F.col("morning_ok")).drop("hours_present"))


def coordinate_quality(master: DataFrame, lat_box=(41.0, 43.0), lng_box=(-89.0, -87.0)) -> DataFrame:
    return master.agg(
        F.count(F.lit(1)).alias("stations"), F.count_if(F.col("lat").isNull()).alias("missing_lat"),
        F.count_if(F.col("lng").isNull()).alias("missing_lng"),
        F.count_if((F.col("lat") < lat_box[0]) | (F.col("lat") > lat_box[1])).alias("lat_outside_box"),
        F.count_if((F.col("lng") < lng_box[0]) | (F.col("lng") > lng_box[1])).alias("lng_outside_box"))
