import datetime as dt

import pytest
from pyspark.sql import functions as F

from tallycast.config import HOUR
from tallycast.operators import backtest as bt
from tallycast.operators import experiments as ex
from tallycast.operators import features, profile, promote
from tallycast.streaming import hourly


def test_streaming_counts_match_batch_and_are_idempotent(spark, tmp_path):
    start = dt.datetime(2025, 1, 1)
    rows = [(f"k{i % 3}", start + dt.timedelta(minutes=17 * i)) for i in range(400)]
    df = spark.createDataFrame(rows, "station_id string, started_at timestamp_ntz")
    landing, sink, ckpt = (str(tmp_path / x) for x in ("landing", "sink", "ckpt"))
    df.where(F.col("started_at") < start + dt.timedelta(hours=30)).write.parquet(landing)
    hourly.run_hourly_counts(spark, landing, df.schema, sink, ckpt)
    df.where(F.col("started_at") >= start + dt.timedelta(hours=30)).write.mode("append").parquet(landing)
    hourly.run_hourly_counts(spark, landing, df.schema, sink, ckpt)
    hourly.run_hourly_counts(spark, landing, df.schema, sink, ckpt)  # nothing new: no change
    got = {(r.station_id, r.hour): r.trips for r in hourly.read_counts(spark, sink).collect()}
    want = {(r.station_id, r.hour): r.n for r in df.groupBy("station_id", F.date_trunc("hour", "started_at")
                                                           .cast("timestamp_ntz").alias("hour"))
            .agg(F.count(F.lit(1)).alias("n")).collect()}
    assert got == want


def test_profiles_and_volume_ranking(spark):
    start = dt.datetime(2025, 1, 6)  # a Monday
    rows = [("A", start + dt.timedelta(hours=17), "member")] * 5 + [("B", start + dt.timedelta(hours=3), "casual")] * 2
    df = spark.createDataFrame(rows, "station_id string, started_at timestamp_ntz, member_casual string")
    hp = {(r.hour, r.is_weekend): r.trips for r in profile.hourly_profile(df).collect()}
    assert hp == {(17, False): 5, (3, False): 2}
    rk = profile.volume_ranking(df).orderBy("rank").collect()
    assert [(r.station_id, r.rank) for r in rk] == [("A", 1), ("B", 2)] and rk[-1].cum_share == 1.0
    s = profile.shift_sanity(df).first()
    assert s.peak_hour == 17 and s.passed is False  # no morning traffic at 8h


def periodic(spark, days=120, start=dt.datetime(2025, 1, 1)):
    rows = [("A", start + dt.timedelta(hours=i), (i % 168) % 7 + (i // 24) % 2) for i in range(days * 24)]
    df = spark.createDataFrame(rows, "station_id string, hour timestamp_ntz, trips int")
    return features.add_lag_features(features.add_calendar_features(df), HOUR)


def test_promotion_wait_keep_promote(spark):
    f = periodic(spark)
    naive, hist = bt.SeasonalNaive(HOUR), bt.HistoricalMean()
    late = {"model_version": "v1", "train_through": "2025-04-15 23:00:00"}
    assert promote.promote_if_better(f, naive, hist, late, HOUR).first().status == "waiting_for_unseen_month"
    early = {"model_version": "v1", "train_through": "2025-02-10 23:00:00"}
    d = promote.promote_if_better(f, naive, naive, early, HOUR).first()
    assert d.status == "kept" and d.eval_month == "2025-04"  # equal MAE is not a 2 % improvement
    d2 = promote.promote_if_better(f, naive, hist, early, HOUR, min_improvement=0.0).first()
    assert d2.status in ("promoted", "kept") and d2.mae_current is not None
    with pytest.raises(ValueError):
        promote.promote_if_better(f, naive, hist, early, HOUR, min_improvement=1.0)


def test_select_run_and_leaderboard(spark, tmp_path):
    res = spark.createDataFrame([("p", "2025-01", 1.0, 2.0, 10)], "predictor string, window string, mae double, "
                                                                    "rmse double, n bigint")
    runs = str(tmp_path / "runs")
    ex.log_run(res, runs, "sweep-a", "base", {"x": 1})
    ex.log_run(res.withColumn("mae", F.lit(0.5)), runs, "sweep-b", "x=2", {"x": 2})
    table = spark.read.parquet(runs)
    lb = ex.leaderboard(table, "sweep").collect()
    assert [r.candidate for r in lb] == ["x=2", "base"]
    assert ex.select_run(table, "sweep-a").count() == 1
    with pytest.raises(ValueError, match="exactly one"):
        ex.select_run(table, "sweep")
    assert [c for c, _ in ex.sweep_candidates({"a": 1, "b": 2}, {"a": [1, 3], "b": [5]})] == ["base", "a=3", "b=5"]


def test_distributed_rank_equals_global_window(spark):
    from pyspark.sql import Window
    rows = [(f"k{i:04d}", (i * 7919) % 37) for i in range(1000)]
    df = spark.createDataFrame(rows, "station_id string, trips bigint")
    order = [F.desc("trips"), F.asc("station_id")]
    got = {r.station_id: (r.rank, r.running) for r in profile.distributed_rank(df, order, "trips", 7).collect()}
    w = Window.orderBy(*order)
    want = {r.station_id: (r.rk, r.rs) for r in df.select(
        "station_id", F.row_number().over(w).alias("rk"),
        F.sum("trips").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("rs")).collect()}
    assert got == want


def test_promotion_retrains_archives_and_refuses_a_used_version(spark, tmp_path):
    import math
    from tallycast.config import DEFAULT
    from tallycast.operators import models
    start = dt.datetime(2025, 1, 1)
    rows = [("A", start + dt.timedelta(hours=i), int(6 * math.exp(-((i % 24 - 9) ** 2) / 9)) + (i // 24) % 3) for i in range(120 * 24)]
    df = spark.createDataFrame(rows, "station_id string, hour timestamp_ntz, trips int")
    f = features.add_lag_features(features.add_calendar_features(df), HOUR)
    cfg = DEFAULT.with_(model_params={"max_iter": 8, "max_depth": 4})
    weak = models.train_production(f.where("hour < '2025-03-05'"), cfg.with_(model_params={"max_iter": 1, "max_depth": 1}), f"{tmp_path}/m/v1",
                                   feature_list=["day_of_week", "lag_24"])
    flist = ["hour_of_day", "lag_24", "lag_168"]
    reg = f"{tmp_path}/registry"
    assert promote.current_version(spark, reg) is None
    d = promote.run_promotion(f, weak, cfg, f"{tmp_path}/m", reg, "v2", feature_list=flist).first()
    assert d.status == "promoted" and d.eval_month == "2025-04" and d.mae_candidate < d.mae_current
    now = promote.current_model(spark, reg).first()
    strong = models.load_artifact(spark, now.artifact_path)
    assert now.new_version == "v2" and strong.metadata["train_through"].startswith("2025-04-30")
    with pytest.raises(ValueError, match="already archived"):
        promote.run_promotion(f, strong, cfg, f"{tmp_path}/m", reg, "v2")
    assert promote.run_promotion(f, strong, cfg, f"{tmp_path}/m", reg, "v3").first().status == "waiting_for_unseen_month"
    assert promote.current_version(spark, reg) == "v2"
