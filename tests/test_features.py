import datetime as dt

from pyspark.sql import functions as F

from tallycast.config import DAY, HOUR
from tallycast.functions.calendar import holiday_calendar
from tallycast.operators import events, features

START = dt.datetime(2025, 3, 1)


def ramp(spark, days=30, key="A"):
    rows = [(key, START + dt.timedelta(hours=i), i) for i in range(days * 24)]
    return spark.createDataFrame(rows, "station_id string, hour timestamp_ntz, trips int")


def test_lag_value_is_exact(spark):
    f = features.add_lag_features(ramp(spark), HOUR)
    r = f.where(F.col("hour") == START + dt.timedelta(hours=400)).first()
    assert (r.lag_24, r.lag_48, r.lag_168) == (376, 352, 232)
    # same-hour mean of t-24 ... t-168 (7 days) and t-24 ... t-672 (only 16 available)
    assert r.roll_mean_7d == sum(400 - 24 * k for k in range(1, 8)) / 7
    assert r.roll_mean_28d == sum(400 - 24 * k for k in range(1, 17)) / 16


def test_rolling_mean_equals_shift_definition(spark):
    f = features.add_lag_features(ramp(spark, 40), HOUR).collect()
    by_hour = {r.hour: r.trips for r in f}
    for r in f[::37]:
        vals = [by_hour.get(r.hour - dt.timedelta(hours=24 * k)) for k in range(1, 8)]
        vals = [v for v in vals if v is not None]
        expected = sum(vals) / len(vals) if vals else None
        assert r.roll_mean_7d == expected


def test_leakage_guard_is_metamorphic(spark):
    """Corrupting everything after H-24 must not change features at H."""
    base = ramp(spark)
    h = START + dt.timedelta(hours=500)
    corrupt = base.withColumn("trips", F.when(F.col("hour") > h - dt.timedelta(hours=24), F.lit(-999))
                              .otherwise(F.col("trips")))
    cols = ["lag_24", "lag_48", "lag_168", "roll_mean_7d", "roll_mean_28d"]
    a = features.add_lag_features(base, HOUR).where(F.col("hour") == h).select(cols).first()
    b = features.add_lag_features(corrupt, HOUR).where(F.col("hour") == h).select(cols).first()
    assert a == b


def test_lags_do_not_cross_keys(spark):
    rows = [(k, START + dt.timedelta(hours=i), v) for k, v in (("A", 1000), ("B", 1)) for i in range(5 * 24)]
    df = spark.createDataFrame(rows, "station_id string, hour timestamp_ntz, trips int")
    f = features.add_lag_features(df, HOUR)
    assert {r.lag_24 for r in f.where("station_id = 'B' and lag_24 is not null").collect()} == {1}
    assert f.where("station_id = 'A'").agg(F.max("roll_mean_7d")).first()[0] == 1000


def test_short_lag_is_rejected():
    from tallycast.config import Grain
    bad = Grain("hour", 24, 168, (12, 24), (7,), 24, "hour_of_day", "d")
    try:
        features.add_lag_features(None, bad)
    except ValueError as e:
        assert "horizon" in str(e)
    else:
        raise AssertionError


def test_calendar_iso_weekday_and_holidays(spark):
    df = spark.createDataFrame([(dt.datetime(2025, 7, 5, 8),), (dt.datetime(2025, 7, 4, 8),),
                                (dt.datetime(2021, 12, 31, 0),), (dt.datetime(2025, 11, 27, 0),)], "hour timestamp_ntz")
    r = features.add_calendar_features(df).orderBy("hour").collect()
    by = {x.hour: x for x in r}
    assert by[dt.datetime(2025, 7, 5, 8)].day_of_week == 6 and by[dt.datetime(2025, 7, 5, 8)].is_weekend
    assert by[dt.datetime(2025, 7, 4, 8)].is_holiday
    assert by[dt.datetime(2021, 12, 31, 0)].is_holiday  # New Year 2022 falls on a Saturday
    assert by[dt.datetime(2025, 11, 27, 0)].is_holiday  # Thanksgiving
    names = {r.holiday for r in holiday_calendar(spark, 2025, 2025).collect()}
    assert "Memorial Day" in names and len(names) >= 13


def test_event_flag_keeps_rows_and_dedupes(spark):
    cal = spark.createDataFrame([(dt.date(2025, 3, 2), dt.date(2025, 3, 3), "x"),
                                 (dt.date(2025, 3, 3), dt.date(2025, 3, 3), "y")],
                                "start_date date, end_date date, event_name string")
    days = events.event_days(cal)
    assert days.count() == 2
    g = ramp(spark, 5)
    out = events.add_event_feature(g, days)
    assert out.count() == g.count()
    flagged = {r.hour.date() for r in out.where("is_major_event = 1").collect()}
    assert flagged == {dt.date(2025, 3, 2), dt.date(2025, 3, 3)}


def test_covariate_gate_rejects_missing_coverage(spark):
    from tallycast.config import DEFAULT
    g = ramp(spark, 2)
    cov = spark.createDataFrame([(START, 1.0, 0.0, 0.0, 1.0, 50.0)],
                                "timestamp timestamp_ntz, temperature_2m double, precipitation double, snowfall double,"
                                " wind_speed_10m double, relative_humidity_2m double")
    try:
        features.add_covariates(g, cov, DEFAULT)
    except ValueError as e:
        assert "matched only" in str(e)
    else:
        raise AssertionError


def test_day_grain_lags(spark):
    rows = [("A", dt.datetime(2025, 1, 1) + dt.timedelta(days=i), i) for i in range(60)]
    df = spark.createDataFrame(rows, "station_id string, hour timestamp_ntz, trips int")
    r = features.add_lag_features(df, DAY).where(F.col("trips") == 40).first()
    assert (r.lag_7, r.lag_14, r.lag_28, r.roll_mean_4w) == (33, 26, 12, (33 + 26 + 19 + 12) / 4)
