import datetime as dt

from pyspark.sql import functions as F

from tallycast.config import DEFAULT, HOUR
from tallycast.operators import cleaning, grid
from tallycast.schemas import TRIPS

T0 = dt.datetime(2025, 1, 1, 8, 0, 0)


def trip(spark_rows, rid, start, seconds, station):
    spark_rows.append((rid, "classic", start, start + dt.timedelta(seconds=seconds), "S", station, None, None,
                       41.9, -87.6, 41.9, -87.6, "member"))


def six_trips(spark):
    rows = []
    trip(rows, "good", T0, 600, "A")
    trip(rows, "short", T0, 30, "A")
    trip(rows, "negative", T0, -100, "A")
    trip(rows, "long", T0, 26 * 3600, "A")
    trip(rows, "nostation", T0, 600, None)
    trip(rows, "remapped", T0, 900, "OLD")
    return spark.createDataFrame(rows, TRIPS)


def test_removal_report_counts_overlapping_rules(spark):
    r = cleaning.removal_report(six_trips(spark), DEFAULT).first().asDict()
    assert r == {"total": 6, "missing_station": 1, "too_short_or_negative": 2, "too_long": 1}


def test_clean_and_mapping_keep_two_rows(spark):
    mapping = spark.createDataFrame([("OLD", "A")], "raw_station_id string, canonical_station_id string")
    out = cleaning.clean_trips(six_trips(spark), DEFAULT, mapping).orderBy("ride_id").collect()
    assert [(r.ride_id, r.station_id) for r in out] == [("good", "A"), ("remapped", "A")]


def test_duplicate_mapping_keys_are_rejected(spark):
    mapping = spark.createDataFrame([("OLD", "A"), ("OLD", "B")], "raw_station_id string, canonical_station_id string")
    try:
        cleaning.clean_trips(six_trips(spark), DEFAULT, mapping)
    except ValueError as e:
        assert "duplicate" in str(e)
    else:
        raise AssertionError("duplicate raw ids must be rejected")


def thirteen(spark):
    rows = []
    for i in range(12):
        trip(rows, f"a{i}", T0 + dt.timedelta(hours=6 * i), 600, "A")
    trip(rows, "b0", T0 + dt.timedelta(hours=5), 600, "B")
    return cleaning.clean_trips(spark.createDataFrame(rows, TRIPS), DEFAULT)


def test_full_grid_is_dense_and_conserves_counts(spark):
    clean = thirteen(spark)
    scope = grid.select_scope(clean, 10)
    counts = grid.series_counts(clean, scope, HOUR)
    g = grid.full_grid(counts, scope, HOUR)
    ident = grid.grid_identity(g).first()
    assert ident.is_complete and ident.n_keys == 2
    assert ident.n_hours == 6 * 11 + 1
    assert g.agg(F.sum("trips")).first()[0] == 13
    assert g.where("station_id = 'B' and trips = 0").count() == ident.n_hours - 1
    assert "CartesianProduct" not in g._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoopJoin" not in g._jdf.queryExecution().executedPlan().toString()


def test_scope_top_n_tie_break(spark):
    clean = thirteen(spark)
    assert [r.station_id for r in grid.select_scope(clean, 1).collect()] == ["A"]


def test_trim_to_lifetime_drops_rows_before_first_month(spark):
    rows = []
    trip(rows, "early", dt.datetime(2025, 5, 10, 8), 600, "A")
    trip(rows, "late", dt.datetime(2025, 6, 3, 8), 600, "B")
    clean = cleaning.clean_trips(spark.createDataFrame(rows, TRIPS), DEFAULT)
    scope = grid.select_scope(clean, 10)
    g = grid.full_grid(grid.series_counts(clean, scope, HOUR), scope, HOUR)
    t = grid.trim_to_lifetime(g, clean, scope=scope)
    first_b = t.where("station_id = 'B'").agg(F.min("hour")).first()[0]
    assert first_b == dt.datetime(2025, 6, 1)
    assert t.where("station_id = 'A'").count() == g.where("station_id = 'A'").count()


def test_station_master_and_panel(spark):
    rows = []
    trip(rows, "1", T0, 600, "A")
    trip(rows, "2", T0 + dt.timedelta(days=40), 600, "A")
    df = spark.createDataFrame(rows, TRIPS).withColumn("member_casual", F.when(F.col("ride_id") == "2", "casual")
                                                       .otherwise("member"))
    clean = cleaning.clean_trips(df, DEFAULT)
    m = grid.station_master(clean).first()
    assert (m.name, m.total_trips, m.first_month, m.last_month) == ("S", 2, "2025-01", "2025-02")
    p = {r.month: (r.member_trips, r.casual_trips, r.total_trips) for r in grid.station_month_panel(clean).collect()}
    assert p == {"2025-01": (1, 0, 1), "2025-02": (0, 1, 1)}


def test_medians_are_exact_for_odd_even_and_missing_values(spark):
    rows = [("a", 3.0), ("a", 1.0), ("a", 2.0), ("b", 1.0), ("b", 4.0), ("b", 4.0), ("b", 2.0), ("c", None), ("d", 5.0), ("d", None)]
    df = spark.createDataFrame(rows, "station_id string, v double")
    got = {r.station_id: r.v for r in grid.exact_medians(df, "station_id", ["v"]).collect()}
    assert got == {"a": 2.0, "b": 3.0, "d": 5.0}


def test_panel_keeps_unlisted_rider_types(spark):
    rows = []
    for i in range(4):
        trip(rows, f"p{i}", T0 + dt.timedelta(minutes=i), 600, "P")
    df = spark.createDataFrame(rows, TRIPS).withColumn("member_casual", F.when(F.col("ride_id") == "p0", "guest").otherwise("member"))
    r = grid.station_month_panel(df.withColumn("station_id", F.col("start_station_id"))).first()
    assert (r.member_trips, r.casual_trips, r.total_trips, r.guest_trips) == (3, 0, 3, 1)
