import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from tallycast.config import HOUR
from tallycast.operators import features, gates, grid
from tallycast.sources import sinks
from tallycast.sources.weather import assert_unique_time


def test_sinks_write_csv_and_one_record_json(spark, tmp_path):
    df = spark.createDataFrame([("a", 1.5)], "predictor string, mae double")
    sinks.write_csv(df, str(tmp_path / "csv"))
    assert spark.read.option("header", True).csv(str(tmp_path / "csv")).first().predictor == "a"
    rec = df.select(F.struct("predictor", "mae").alias("gate"), F.array(F.lit("x")).alias("columns"))
    sinks.write_record(rec, str(tmp_path / "json"))
    files = list((tmp_path / "json").glob("*.json"))
    assert len(files) == 1 and json.loads(files[0].read_text())["gate"]["mae"] == 1.5
    sinks.write_parquet(df.withColumn("month", F.lit("2025-01")), str(tmp_path / "pq"), ["month"])
    assert spark.read.parquet(str(tmp_path / "pq")).count() == 1


def test_guards(spark):
    w = spark.createDataFrame([(dt.datetime(2025, 1, 1),)] * 2, "timestamp timestamp_ntz")
    with pytest.raises(ValueError, match="duplicate"):
        assert_unique_time(w)
    ok = spark.createDataFrame([(True,)], "passed boolean")
    assert gates.raise_if_failed(ok) is ok
    with pytest.raises(gates.GateFailed):
        gates.raise_if_failed(spark.createDataFrame([(False,)], "passed boolean"))
    features.assert_no_leak([24, 48], 24)
    for args in (([12, 24], 24), ([24], 24, dt.date(2025, 2, 1), dt.date(2025, 1, 1))):
        with pytest.raises(ValueError, match="leak"):
            features.assert_no_leak(*args)
    start = dt.datetime(2025, 1, 1)
    hours = spark.createDataFrame([(k, start + dt.timedelta(hours=i), i % 11) for k in "AB" for i in range(24 * 12)], "station_id string, hour timestamp_ntz, trips int")
    good = gates.leakage_gate(hours, HOUR, start + dt.timedelta(hours=24 * 10 - 1)).first()
    assert good.passed and good.checked_rows == 2 * 24 * 11 and good.leaked_rows == 0

    def peeks(grid, grain):
        ahead = grid.select("station_id", (F.col("hour") - F.expr("INTERVAL 1 HOUR")).alias("hour"), F.col("trips").alias("lag_24"))
        return features.add_lag_features(grid, grain).drop("lag_24").join(ahead, ["station_id", "hour"], "left")
    bad = gates.leakage_gate(hours, HOUR, start + dt.timedelta(hours=24 * 10 - 1), peeks).first()
    assert not bad.passed and bad.leaked_rows == 2 * 25
    holey = spark.createDataFrame([("A", dt.datetime(2025, 1, 1, 0), 1), ("A", dt.datetime(2025, 1, 1, 1), 1),
                                   ("B", dt.datetime(2025, 1, 1, 0), 1)], "station_id string, hour timestamp_ntz, trips int")
    with pytest.raises(ValueError, match="not dense"):
        grid.assert_grid_complete(holey)


def test_unreadable_files_fail_loudly_and_leave_the_store(spark, tmp_path):
    from tallycast.operators import forecast as fc
    from tallycast.sources.trips import stored_months
    from tallycast.streaming import hourly

    day = dt.date(2025, 1, 1)
    preds = spark.createDataFrame([("A", dt.datetime(2025, 1, 2), 1.0)], "station_id string, hour timestamp_ntz, prediction double")
    store = f"{tmp_path}/store"
    assert fc.write_partition(preds, store, day, "v1") == "written"
    assert fc.write_partition(preds, store, day, "v1") == "skipped"
    part = tmp_path / "store" / "commits" / f"as_of={day}"
    (part / "00000002.json").write_bytes(b"not json")
    before = sorted(p.name for p in part.iterdir())
    with pytest.raises(Exception):
        fc.write_partition(preds, store, day, "v2")
    assert sorted(p.name for p in part.iterdir()) == before
    sink = f"{tmp_path}/sink"
    counts = spark.createDataFrame([("A", dt.datetime(2025, 1, 1, 5), 3), ("B", dt.datetime(2025, 1, 1, 6), 4)], "station_id string, hour timestamp_ntz, trips bigint")
    hourly.upsert_counts(counts, sink)
    hourly.upsert_counts(spark.createDataFrame([("C", dt.datetime(2025, 1, 1, 7), 1)], counts.schema), sink)
    assert {r.station_id for r in hourly.read_counts(spark, sink).collect()} == {"A", "B", "C"}
    (tmp_path / "sink" / "day=2025-01-01" / "part-bad.snappy.parquet").write_bytes(b"not parquet")
    with pytest.raises(Exception):
        hourly.upsert_counts(spark.createDataFrame([("D", dt.datetime(2025, 1, 1, 8), 1)], counts.schema), sink)
    assert stored_months(spark, f"{tmp_path}/none").collect() == []


def test_nothing_matched_and_duplicate_dimensions_are_errors(spark):
    from tallycast.config import DEFAULT
    from tallycast.operators import features
    from tallycast.operators import forecast as fc

    detail = spark.createDataFrame([], "as_of date, hour timestamp_ntz, absolute_error double")
    with pytest.raises(ValueError, match="no forecast"):
        fc.evaluate_predictions(detail)
    grid_rows = spark.createDataFrame([("A", dt.datetime(2025, 1, 1), 1)], "station_id string, hour timestamp_ntz, trips int")
    twice = spark.createDataFrame([("A", 1.0, 2.0)] * 2, "station_id string, lat double, lng double")
    with pytest.raises(ValueError, match="more than once"):
        features.add_station_features(grid_rows, twice, DEFAULT)
    hours = spark.createDataFrame([(dt.datetime(2025, 1, 1), 1.0)] * 2, "timestamp timestamp_ntz, temperature_2m double")
    with pytest.raises(ValueError, match="duplicate"):
        features.add_covariates(grid_rows, hours, DEFAULT)
