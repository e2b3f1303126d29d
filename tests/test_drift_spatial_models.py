import datetime as dt
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallycast.operators import drift, spatial
from tallycast.functions.geo import EARTH_RADIUS_M


def frames(spark, shift):
    rng = np.random.default_rng(7)
    ref = [(float(a), float(b)) for a, b in zip(rng.normal(20, 5, 3000), rng.poisson(4, 3000))]
    cur = [(float(a) + shift, float(b) + shift) for a, b in zip(rng.normal(20, 5, 800), rng.poisson(4, 800))]
    sch = "temperature_2m double, lag_24 double"
    return spark.createDataFrame(ref, sch), spark.createDataFrame(cur, sch)


def test_drift_gate_same_vs_shifted(spark):
    r, c = frames(spark, 0)
    assert drift.drift_gate(r, c).first().passed
    r, c = frames(spark, 12)
    g = drift.drift_gate(r, c).first()
    assert not g.passed and g.drift_share == 1.0


def test_w1_matches_quantile_definition(spark):
    r, c = frames(spark, 3)
    s = {x.column: x for x in drift.drift_statistics(r, c, ["temperature_2m"]).collect()}["temperature_2m"]
    a = np.sort(np.array([x[0] for x in r.collect()]))
    b = np.sort(np.array([x[0] for x in c.collect()]))
    grid = np.sort(np.concatenate([a, b]))
    fa = np.searchsorted(a, grid, side="right") / len(a)
    fb = np.searchsorted(b, grid, side="right") / len(b)
    w1 = float(np.sum(np.abs(fa - fb)[:-1] * np.diff(grid)))
    assert math.isclose(s.w1, w1, rel_tol=1e-9)
    assert math.isclose(s.ks, float(np.max(np.abs(fa - fb))), rel_tol=1e-12)


def test_stored_days_give_the_direct_statistics(spark, tmp_path):
    rng = np.random.default_rng(11)
    start, cols = dt.datetime(2025, 1, 1), ["temperature_2m", "lag_24", "flat"]
    rows = [(start + dt.timedelta(hours=3 * i), float(round(rng.normal(20 + (i > 200) * 3, 4), 1)), None if i % 17 == 0 else float(rng.poisson(3)), 1.0) for i in range(320)]
    df = spark.createDataFrame(rows, "hour timestamp_ntz, temperature_2m double, lag_24 double, flat double")
    days = [dt.date(2025, 1, 1) + dt.timedelta(days=i) for i in range(40)]
    path = f"{tmp_path}/h"
    assert drift.record_days(df, path, days[:30], cols) == days[:30]
    assert drift.record_days(df, path, days, cols) == days[30:] and drift.record_days(df, path, days, cols) == []
    got = drift.drift_of_days(spark, path, (days[0], days[24]), (days[25], days[39])).orderBy("column").collect()
    cut = F.col("hour") < F.lit(dt.datetime(2025, 1, 26))
    want = drift.drift_statistics(df.where(cut), df.where(~cut), cols[:2]).orderBy("column").collect()
    assert [r.column for r in got] == ["lag_24", "temperature_2m"]
    for a, b in zip(got, want):
        assert a.n_ref == b.n_ref and a.n_cur == b.n_cur and a.drifted == b.drifted
        assert math.isclose(a.w1, b.w1, rel_tol=1e-9) and math.isclose(a.ks, b.ks, rel_tol=1e-9) and math.isclose(a.ref_std, b.ref_std, rel_tol=1e-9)
    with pytest.raises(ValueError, match="no histogram"):
        drift.merged_days(spark, path, days[0], dt.date(2025, 3, 1))


def test_no_usable_columns_passes(spark):
    r = spark.createDataFrame([(1.0,)] * 5, "temperature_2m double")
    g = drift.drift_gate(r, r).first()
    assert g.passed and g.n_columns == 0


def brute(points, max_m=30.0):
    out = set()
    for i, a in enumerate(points):
        for b in points[i + 1:]:
            p1, p2 = math.radians(a[1]), math.radians(b[1])
            dp, dl = math.radians(b[1] - a[1]), math.radians(b[2] - a[2])
            h = math.sin(dp / 2) ** 2 + math.cos(p1) * math.cos(p2) * math.sin(dl / 2) ** 2
            d = 2 * EARTH_RADIUS_M * math.asin(math.sqrt(h))
            if d < max_m:
                out.add(tuple(sorted((a[0], b[0]))))
    return out


def test_binned_pairs_equal_brute_force(spark):
    rnd = random.Random(3)
    pts = [(f"s{i:03d}", 41.88 + rnd.uniform(-0.003, 0.003), -87.63 + rnd.uniform(-0.003, 0.003)) for i in range(300)]
    df = spark.createDataFrame([(p[0], "n", p[1], p[2], 1) for p in pts],
                               "station_id string, station_name string, lat double, lng double, total_trips bigint")
    pairs = spatial.near_pairs(df)
    got = {(r.id_a, r.id_b) for r in pairs.collect()}
    assert got == brute(pts) and len(got) > 10
    plan = pairs._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoopJoin" not in plan and "CartesianProduct" not in plan


def test_a_hot_cell_is_spread_over_many_keys(spark):
    rnd = random.Random(4)
    # 98 % of the points within one cell, the rest around it
    pts = [(f"h{i:03d}", 41.88 + rnd.uniform(0, 2e-5), -87.63 + rnd.uniform(0, 2e-5)) for i in range(294)]
    pts += [(f"t{i}", 41.88 + rnd.uniform(-4e-4, 4e-4), -87.63 + rnd.uniform(-4e-4, 4e-4)) for i in range(6)]
    df = spark.createDataFrame([(p[0], "n", p[1], p[2], 1) for p in pts],
                               "station_id string, station_name string, lat double, lng double, total_trips bigint")
    pairs = spatial.near_pairs(df, cell_rows=40)
    got = [(r.id_a, r.id_b) for r in pairs.collect()]
    assert len(got) == len(set(got)) and set(got) == brute(pts)
    plan = pairs._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoopJoin" not in plan and "CartesianProduct" not in plan
    # the keys that the two sides meet under
    sides = pairs._jdf.queryExecution().optimizedPlan().toString()
    assert sides.count("Generate explode(sequence(0") == 2


def test_edges_flatten_chains(spark):
    pairs = spark.createDataFrame([
        ("a", "Dock & Pier", 1, "b", "dock and  pier", 5, 3.0),
        ("b", "Dock & Pier", 5, "c", "DOCKANDPIER", 9, 4.0),
        ("c", "x", 9, "d", "y", 1, 5.0)],
        "id_a string, name_a string, trips_a bigint, id_b string, name_b string, trips_b bigint, dist_m double")
    edges = spatial.duplicate_edges(pairs)
    flat = {r.raw_station_id: r.canonical_station_id for r in spatial.flatten_mapping(edges).collect()}
    assert flat == {"a": "c", "b": "c"}
    g = spatial.mapping_guards(spatial.flatten_mapping(edges)).first()
    assert g.passed and g.chains == 0


def test_model_beats_naive_and_handles_unknown_key(spark):
    from tallycast.config import DEFAULT, HOUR
    from tallycast.operators import backtest as bt, features, models
    rng = np.random.default_rng(1)
    start = dt.datetime(2025, 1, 1)
    rows = []
    for k, scale in (("A", 3.0), ("B", 6.0)):
        for i in range(100 * 24):
            h = i % 24
            lam = scale * (math.exp(-((h - 8) ** 2) / 4) + math.exp(-((h - 17) ** 2) / 4)) + 0.1
            rows.append((k, start + dt.timedelta(hours=i), int(rng.poisson(lam))))
    df = spark.createDataFrame(rows, "station_id string, hour timestamp_ntz, trips int")
    f = features.add_lag_features(features.add_calendar_features(df), HOUR).persist()
    feats = ["hour_of_day", "day_of_week", "station_id", "lag_24", "lag_168", "roll_mean_7d"]
    p = models.ModelPredictor("gbt", feats, {"max_iter": 15, "max_depth": 4}, "gbt")
    res = {r.predictor: r.mae for r in bt.run_backtest(f, [p, bt.SeasonalNaive(HOUR)], 1, HOUR).collect()}
    assert res["gbt"] < res["seasonal_naive"]
    model, _ = models.fit_model(f.where("station_id = 'A' or hour < '2025-02-01'"), feats, {"max_iter": 5}, "gbt")
    unseen = f.where("station_id = 'B'").withColumn("station_id", F.lit("C")).limit(50)
    scored = models.score(model, unseen, feats)
    assert scored.where("prediction is null or prediction < 0").count() == 0 and scored.count() == 50


def test_categorical_levels_tree_count_and_metadata(spark, tmp_path):
    from tallycast.config import DEFAULT, HOUR
    from tallycast.operators import features, models
    rng = np.random.default_rng(3)
    start = dt.datetime(2025, 1, 20)
    rows = [(k, start + dt.timedelta(hours=i), int(rng.poisson(3 if k == "A" else 1)), c)
            for k, c in (("A", "busy"), ("B", "unknown")) for i in range(40 * 24)]
    df = spark.createDataFrame(rows, "station_id string, hour timestamp_ntz, trips int, cluster string")
    f = features.add_lag_features(features.add_calendar_features(df), HOUR)
    feats = ["hour_of_day", "station_id", "cluster", "lag_24"]
    model, mae = models.fit_model(f, feats, {"max_iter": 6, "max_depth": 2}, "gbt", refit_full=False)
    rows_, design, cats = models.prepare(f.dropna(subset=["lag_24"]).withColumn("_label", F.col("trips").cast("double")), feats)
    _, valid = models.time_based_split(rows_)
    again = model.transform(valid).agg(F.avg(F.abs(F.greatest(F.col("_pred"), F.lit(0.0)) - F.col("_label")))).first()[0]
    assert cats == ["station_id", "cluster"] and models.fitted_trees(model) <= 6 and abs(again - mae) < 1e-9
    art = models.train_production(f, DEFAULT.with_(model_params={"max_iter": 3, "max_depth": 2}), f"{tmp_path}/a", feature_list=feats)
    loaded = models.load_artifact(spark, f"{tmp_path}/a")
    assert loaded.metadata["categories"] == {"station_id": ["A", "B"], "cluster": ["busy", "unknown"]}
    assert loaded.metadata["fitted_n_estimators"] == models.fitted_trees(art.model)
    some = f.where("hour >= '2025-02-20'")
    one = {(r.station_id, r.hour): r.prediction for r in art.score(some).collect()}
    assert one == {(r.station_id, r.hour): r.prediction for r in loaded.score(some).collect()}


def test_drift_needs_rows_and_cycles_are_errors(spark):
    r, c = frames(spark, 0)
    with pytest.raises(ValueError, match="complete rows"):
        drift.drift_statistics(r, c.limit(0), ["temperature_2m"])
    loop = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "a")], "raw_station_id string, canonical_station_id string")
    with pytest.raises(ValueError, match="cycle"):
        spatial.flatten_mapping(loop)
