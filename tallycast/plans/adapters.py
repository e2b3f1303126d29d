"""Adapters from the driver's synthetic tables to the pipeline contracts.

Hour grain: ``events`` -> trips (one event = one trip, user = station).
Day grain: ``orders`` joined to ``lineitem`` -> trips (supplier = station).
Covariates, id mapping and station coordinates are all derived by Spark from
the same tables, so every query's work grows with the data. The DuckDB
oracles (``oracles.py``) restate these adapters in SQL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.exprs import bounded_broadcast, bucket


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _d(x: float):
    return F.lit(float(x))


def events_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trips contract from events. Duration = ``value`` seconds (centisecond
    precision); 'error' events carry no start station, 'view' events no name,
    'signup' events no end station; click/purchase riders are members."""
    e = table(spark, sf_dir, "events")
    uid = F.col("user_id")
    et = F.col("event_type")
    lat = _d(41.8) + uid * _d(1e-4) + (F.col("value") - _d(250.0)) * _d(1e-6)
    lng = _d(-87.6) - uid * _d(1e-4)
    return e.select(
        F.col("event_id").cast("string").alias("ride_id"),
        et.alias("rideable_type"),
        F.col("ts").alias("started_at"),
        F.timestamp_add("MICROSECOND", F.round(F.col("value") * 100).cast("bigint") * 10000,
                        F.col("ts")).alias("ended_at"),
        F.when(et == "view", F.lit(None).cast("string"))
         .otherwise(F.concat(F.lit("Stop "), uid.cast("string"), F.lit("/"), et)).alias("start_station_name"),
        F.when(et == "error", F.lit(None).cast("string")).otherwise(uid.cast("string")).alias("start_station_id"),
        F.lit(None).cast("string").alias("end_station_name"),
        F.when(et == "signup", F.lit(None).cast("string")).otherwise(uid.cast("string")).alias("end_station_id"),
        lat.alias("start_lat"), lng.alias("start_lng"),
        (lat + _d(1e-3)).alias("end_lat"), (lng + _d(1e-3)).alias("end_lng"),
        F.when(et.isin("click", "purchase"), F.lit("member")).otherwise(F.lit("casual")).alias("member_casual"),
    )


def supplier_mapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Id mapping: every supplier that is not the smallest key of its nation
    maps to that smallest key (unique raw ids, no chains, no self maps)."""
    s = table(spark, sf_dir, "supplier")
    canon = s.groupBy("s_nationkey").agg(F.min("s_suppkey").alias("canon"))
    return (s.join(canon, "s_nationkey").where(F.col("s_suppkey") != F.col("canon"))
            .select(F.col("s_suppkey").cast("string").alias("raw_station_id"),
                    F.col("canon").cast("string").alias("canonical_station_id")))


def events_covariates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly covariates on every hour between the first and last event hour:
    hourly event statistics (0 where an hour has no events)."""
    e = table(spark, sf_dir, "events").withColumn("hour", bucket("ts", "hour"))
    b = e.agg(F.min("hour").alias("lo"), F.max("hour").alias("hi"))
    hours = spark.range(1).select(F.explode(F.sequence(b.select("lo").scalar(), b.select("hi").scalar(),
                                                       F.expr("INTERVAL 1 HOUR"))).alias("hour"))
    stats = e.groupBy("hour").agg(
        F.avg("value").alias("v_avg"),
        F.count_if(F.col("event_type") == "error").alias("n_err"),
        F.count(F.lit(1)).alias("n"),
        F.avg(F.when(F.col("event_type") == "view", F.col("value"))).alias("v_view"))
    j = hours.join(stats, "hour", "left")
    err = F.coalesce(F.col("n_err"), F.lit(0))
    return j.select(
        F.col("hour").alias("timestamp"),
        (F.coalesce(F.col("v_avg"), _d(0.0)) / _d(10.0) - _d(5.0)).alias("temperature_2m"),
        (err * _d(0.25)).alias("precipitation"),
        F.when((F.hour("hour") < 6) & (err >= 2), err * _d(0.1)).otherwise(_d(0.0)).alias("snowfall"),
        F.coalesce(F.col("n"), F.lit(0)).cast("double").alias("wind_speed_10m"),
        (F.coalesce(F.col("v_view"), _d(0.0)) / _d(5.0)).alias("relative_humidity_2m"))


def orders_trips(spark: SparkSession, sf_dir: str, stations: DataFrame | None = None) -> DataFrame:
    """Day-grain trips: one line item = one trip started at the order date and
    ended at the ship date; supplier = station; returned items = members. With
    ``stations``, a list of bounded size, the trips of those: the others' line
    items are left out before the join with the orders."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", "o_orderpriority")
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey", "l_shipdate",
                                                 "l_returnflag", "l_quantity", "l_discount")
    if stations is not None:
        li = li.join(bounded_broadcast(stations.select(F.col("station_id").alias("_s"))), F.col("l_suppkey").cast("string") == F.col("_s"), "left_semi")
    j = li.join(o, li["l_orderkey"] == o["o_orderkey"])
    sk = F.col("l_suppkey")
    lat = _d(41.7) + (sk % 97) * _d(1e-3) + F.col("l_discount") * _d(1e-3)
    lng = _d(-87.7) + (sk % 89) * _d(1e-3) + F.col("l_quantity") * _d(1e-5)
    return j.select(
        F.concat(F.col("l_orderkey").cast("string"), F.lit("-"), F.col("l_linenumber").cast("string")).alias("ride_id"),
        F.col("o_orderpriority").alias("rideable_type"),
        F.col("o_orderdate").alias("started_at"),
        F.col("l_shipdate").alias("ended_at"),
        F.concat(F.lit("Supplier "), sk.cast("string")).alias("start_station_name"),
        sk.cast("string").alias("start_station_id"),
        F.lit(None).cast("string").alias("end_station_name"),
        sk.cast("string").alias("end_station_id"),
        lat.alias("start_lat"), lng.alias("start_lng"),
        lat.alias("end_lat"), lng.alias("end_lng"),
        F.when(F.col("l_returnflag") == "R", F.lit("member")).otherwise(F.lit("casual")).alias("member_casual"),
    )


def orders_covariates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily covariates on every day between the first and last order date,
    from line items shipped that day (0 where none)."""
    o = table(spark, sf_dir, "orders").select(bucket("o_orderdate", "day").alias("hour"))
    b = o.agg(F.min("hour").alias("lo"), F.max("hour").alias("hi"))
    days = spark.range(1).select(F.explode(F.sequence(b.select("lo").scalar(), b.select("hi").scalar(),
                                                      F.expr("INTERVAL 1 DAY"))).alias("hour"))
    li = table(spark, sf_dir, "lineitem")
    stats = (li.groupBy(bucket("l_shipdate", "day").alias("hour"))
             .agg(F.avg("l_quantity").alias("q"), F.avg("l_discount").alias("d"), F.avg("l_tax").alias("t"),
                  F.count(F.lit(1)).alias("n"), F.avg("l_extendedprice").alias("p")))
    j = days.join(stats, "hour", "left")
    return j.select(
        F.col("hour").alias("timestamp"),
        F.coalesce(F.col("q"), _d(0.0)).alias("temperature_2m"),
        (F.coalesce(F.col("d"), _d(0.0)) * _d(10.0)).alias("precipitation"),
        (F.coalesce(F.col("t"), _d(0.0)) * _d(10.0)).alias("snowfall"),
        F.coalesce(F.col("n"), F.lit(0)).cast("double").alias("wind_speed_10m"),
        (F.coalesce(F.col("p"), _d(0.0)) / _d(1000.0)).alias("relative_humidity_2m"))


# The named-period calendar used by the event flag. Each pattern
# (start month-day, end month-day, name) repeats every year from 1995 to 2024.
EVENT_PATTERNS = [
    ("01-06", "01-07", "Winter Fest"),
    ("01-07", "01-09", "Auto Show"),
    ("01-15", "01-15", "Parade"),
    ("07-01", "07-04", "Summer Fair"),
    ("07-03", "07-05", "Jazz Fest"),
    ("09-10", "09-12", "Air Show"),
]
EVENT_YEARS = (1995, 2024)


def event_calendar(spark: SparkSession) -> DataFrame:
    pats = spark.createDataFrame(EVENT_PATTERNS, "s string, e string, event_name string")
    years = F.explode(F.sequence(F.lit(EVENT_YEARS[0]), F.lit(EVENT_YEARS[1])))
    return (pats.select("s", "e", "event_name", years.alias("yi")).withColumn("y", F.col("yi").cast("string"))
            .select(F.to_date(F.concat_ws("-", "y", "s")).alias("start_date"),
                    F.to_date(F.concat_ws("-", "y", "e")).alias("end_date"), "event_name"))


def spatial_stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Station table for the distance join: points from the first two embedding
    dimensions (fields of 500 points, about 1.8 km across), names with case / '&' / spacing
    variants, volume = line items of the part with the same id."""
    emb = table(spark, sf_dir, "embeddings")
    vol = table(spark, sf_dir, "lineitem").groupBy("l_partkey").agg(F.count(F.lit(1)).alias("total_trips"))
    v = F.col("vec_id")
    lab = F.col("label").cast("string")
    name = (F.when(v % 3 == 0, F.concat(F.lit("Dock & Pier "), lab))
            .when(v % 3 == 1, F.concat(F.lit("dock and pier  "), lab))
            .otherwise(F.concat(F.lit("DOCK "), lab)))
    pts = emb.select(
        v.cast("string").alias("station_id"), name.alias("station_name"),
        # a new field, 0.05 degrees further, every 500 points: the area grows with the table
        (_d(41.85) + F.floor(v / 500).cast("double") * _d(0.05) + F.element_at("embedding", 1).cast("double") * _d(0.02)).alias("lat"),
        (_d(-87.65) + F.element_at("embedding", 2).cast("double") * _d(0.02)).alias("lng"), v.alias("_k"))
    return (pts.join(vol, pts["_k"] == vol["l_partkey"], "left")
            .select("station_id", "station_name", "lat", "lng",
                    F.coalesce(F.col("total_trips"), F.lit(0)).cast("bigint").alias("total_trips")))
