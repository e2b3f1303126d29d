import datetime as dt

import pytest
from pyspark.sql import functions as F

from tallycast.config import DEFAULT, HOUR
from tallycast.operators import backtest as bt
from tallycast.operators import features, forecast as fc, gates
from tallycast.operators.models import NaiveArtifact


def periodic(spark, days=120, start=dt.datetime(2025, 1, 1)):
    """Counts that repeat every week: by weekday and hour, zero at night."""
    def count(h):
        return (3 * h.weekday() + h.hour // 5) % 11 if h.hour >= 6 else 0
    hours = [start + dt.timedelta(hours=i) for i in range(days * 24)]
    df = spark.createDataFrame([("A", h, count(h)) for h in hours], "station_id string, hour timestamp_ntz, trips int")
    return features.add_lag_features(features.add_calendar_features(df), HOUR)


def test_eval_months_full_and_partial(spark):
    f = periodic(spark, 120)  # Jan 1 .. Apr 30 23:00 -> April is complete
    assert [r.window for r in bt.eval_months(f, 4, HOUR).orderBy("window").collect()] == \
        ["2025-01", "2025-02", "2025-03", "2025-04"]
    part = f.where(F.col("hour") < dt.datetime(2025, 4, 30, 22))
    assert [r.window for r in bt.eval_months(part, 2, HOUR).orderBy("window").collect()] == ["2025-02", "2025-03"]


def test_naive_is_perfect_on_weekly_periodic_series(spark):
    f = periodic(spark)
    res = bt.run_backtest(f, [bt.SeasonalNaive(HOUR), bt.HistoricalMean()], 2, HOUR)
    naive = {r.window: r.mae for r in res.where("predictor = 'seasonal_naive'").collect()}
    assert naive and all(v == 0 for v in naive.values())
    hist = {r.window: r.mae for r in res.where("predictor = 'historical_mean'").collect()}
    assert all(v == 0 for v in hist.values())  # weekly profile is constant per (dow, hour)
    s = bt.summarize(res).collect()
    assert {r.predictor for r in s} == {"seasonal_naive", "historical_mean"}
    assert all(r.mase_mean is None for r in s)  # naive MAE 0 -> undefined MASE


def test_prediction_table_is_wide(spark):
    f = periodic(spark)
    pt = bt.prediction_table(f, [bt.SeasonalNaive(HOUR), bt.HistoricalMean()], "2025-04", HOUR, 4)
    assert set(pt.columns) == {"station_id", "hour", "trips", "pred_seasonal_naive", "pred_historical_mean"}
    assert pt.count() == 30 * 24


def serving_world(spark, days=40):
    start = dt.datetime(2025, 1, 1)
    rows = [(k, start + dt.timedelta(hours=i), (i % 24) + (3 if k == "B" else 0)) for k in ("A", "B")
            for i in range(days * 24)]
    return spark.createDataFrame(rows, "station_id string, hour timestamp_ntz, trips int")


def test_train_serve_consistency(spark):
    hist = serving_world(spark)
    as_of = dt.date(2025, 2, 5)
    inf = fc.build_inference_features(hist, None, None, as_of, DEFAULT).drop("trips")
    train = features.build_features(hist, None, None, DEFAULT).drop("trips")
    day = train.where(F.to_date("hour") == dt.date(2025, 2, 6))
    assert inf.count() == 48
    assert sorted(map(tuple, inf.select(sorted(inf.columns)).collect())) == \
        sorted(map(tuple, day.select(sorted(inf.columns)).collect()))


def test_horizon_and_missing_hours_rejected(spark):
    hist = serving_world(spark)
    with pytest.raises(ValueError, match="horizon"):
        fc.build_inference_features(hist, None, None, dt.date(2025, 2, 5), DEFAULT, horizon=48)
    holey = hist.where(~((F.col("station_id") == "B") & (F.col("hour") == dt.datetime(2025, 2, 1, 5))))
    with pytest.raises(ValueError, match="incomplete"):
        fc.build_inference_features(holey, None, None, dt.date(2025, 2, 5), DEFAULT)


def test_store_is_idempotent_and_versioned(spark, tmp_path):
    hist = serving_world(spark)
    art = NaiveArtifact("lag_168")
    path = str(tmp_path / "store")
    d = dt.date(2025, 2, 5)
    assert fc.run_batch_predict(d, hist, None, None, DEFAULT, art, art.metadata, path) == "written"
    assert fc.run_batch_predict(d, hist, None, None, DEFAULT, art, art.metadata, path) == "skipped"
    other = NaiveArtifact("lag_168", version="other-v2")
    with pytest.raises(ValueError, match="belongs to model version"):
        fc.run_batch_predict(d, hist, None, None, DEFAULT, other, other.metadata, path)
    leaky = NaiveArtifact("lag_168", train_through="2025-03-01")
    with pytest.raises(ValueError, match="leak"):
        fc.run_batch_predict(d, hist, None, None, DEFAULT, leaky, leaky.metadata, path)
    fc.run_batch_predict(d + dt.timedelta(days=1), hist, None, None, DEFAULT, art, art.metadata, path)
    store = fc.read_store(spark, path)
    assert store.select("as_of").distinct().count() == 2
    health = fc.store_health(store).first()
    assert health.partitions == 2 and health.newest_as_of == d + dt.timedelta(days=1)
    daily = fc.evaluate_predictions(fc.prediction_actual_table(store, hist)).collect()
    assert all(r.mae == 0 for r in daily)  # the series is daily periodic: last week's value is exact
    look = fc.forecast_lookup(store, "A").collect()
    assert len(look) == 24 and look[0].hour < look[-1].hour


def test_empty_store_errors(spark, tmp_path):
    with pytest.raises(ValueError):
        fc.read_store(spark, str(tmp_path / "nothing"))


def test_performance_gate_both_ways(spark):
    daily = spark.createDataFrame([(dt.date(2025, 1, 1), 1.0, 10), (dt.date(2025, 1, 2), 1.4, 10)],
                                  "target_date date, mae double, n bigint")
    assert gates.performance_gate(daily, 1.0, 0.2).first().passed
    assert not gates.performance_gate(daily, 0.9, 0.2).first().passed
    with pytest.raises(ValueError):
        gates.performance_gate(daily, 0.0)


def test_multi_day_store_write_matches_single_days(spark, tmp_path):
    hist = serving_world(spark)
    art = NaiveArtifact("lag_168")
    days = [dt.date(2025, 2, 5), dt.date(2025, 2, 6)]
    a, b = str(tmp_path / "a"), str(tmp_path / "b")
    for d in days:
        fc.run_batch_predict(d, hist, None, None, DEFAULT, art, art.metadata, a)
    st = fc.run_batch_predict_days(days, hist, None, None, DEFAULT, art, art.metadata, b)
    assert set(st.values()) == {"written"}
    assert set(fc.run_batch_predict_days(days, hist, None, None, DEFAULT, art, art.metadata, b).values()) == {"skipped"}
    cols = ["as_of", "station_id", "hour", "prediction", "model_version"]
    assert sorted(map(tuple, fc.read_store(spark, a).select(cols).collect())) == \
        sorted(map(tuple, fc.read_store(spark, b).select(cols).collect()))
    other = NaiveArtifact("lag_168", version="v9")
    with pytest.raises(ValueError, match="belongs to model version"):
        fc.run_batch_predict_days(days, hist, None, None, DEFAULT, other, other.metadata, b)
