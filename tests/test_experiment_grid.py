import datetime as dt
import math

import numpy as np
import pytest

from tallycast.config import HOUR
from tallycast.operators import backtest as bt
from tallycast.operators import experiments as ex
from tallycast.operators import features
from tallycast.operators import models as ml
from tallycast.operators import poisson_trees as pt

FEATURES = ["hour_of_day", "day_of_week", "station_id", "lag_24", "lag_168"]


@pytest.fixture(scope="module")
def demand(spark):
    rng, start = np.random.default_rng(1), dt.datetime(2025, 1, 1)
    rows = [(k, start + dt.timedelta(hours=i), int(rng.poisson(s * math.exp(-((i % 24 - 9) ** 2) / 8) + 0.2))) for k, s in (("A", 3.0), ("B", 6.0)) for i in range(120 * 24)]
    df = spark.createDataFrame(rows, "station_id string, hour timestamp_ntz, trips int")
    return features.add_lag_features(features.add_calendar_features(df), HOUR).persist()


def test_an_aborted_grid_goes_on_where_it_stopped(spark, tmp_path, monkeypatch, demand):
    runs = f"{tmp_path}/runs"
    base = {"n_estimators": 3, "num_leaves": 4, "learning_rate": 0.5}
    candidates = {"a": (FEATURES, base), "b": (FEATURES, {**base, "num_leaves": 3}), "c": (FEATURES[:3], base)}
    real, made = pt.fit_many, []

    def counted(rows, specs, **kw):
        if len(made) >= 2:
            raise RuntimeError("the driver was lost")
        made.extend(s.name for s in specs)
        return real(rows, specs, **kw)
    monkeypatch.setattr(pt, "fit_many", counted)
    with pytest.raises(RuntimeError):
        ex.run_grid(demand, candidates, 2, HOUR, runs, "sweep-1", together=2)
    assert len(made) == 2 and len(ex.logged_fits(spark, runs, "sweep-1")) == 2
    monkeypatch.setattr(pt, "fit_many", real)
    assert ex.run_grid(demand, candidates, 2, HOUR, runs, "sweep-1", together=3) == 4
    assert ex.run_grid(demand, candidates, 2, HOUR, runs, "sweep-1") == 0
    table = spark.read.parquet(runs)
    board = ex.leaderboard(table, "sweep").collect()
    assert {r.candidate for r in board} == {"a", "b", "c"} and all(r.mae_std is not None and r.mase_mean > 0 for r in board)
    # one row per fit, and the baseline once
    assert table.count() == 3 * 2 + 2
    assert ex.run_grid(demand, {"a": (FEATURES, {**base, "num_leaves": 5})}, 2, HOUR, runs, "sweep-1") == 2  # other parameters are another fit


def test_the_grid_gives_what_single_predictors_give(spark, tmp_path, demand):
    params = {"n_estimators": 3, "num_leaves": 4, "learning_rate": 0.5}
    ex.run_grid(demand, {"a": (FEATURES, params)}, 2, HOUR, f"{tmp_path}/r", "one")
    got = {r.window: r.mae for r in spark.read.parquet(f"{tmp_path}/r").where("candidate = 'a'").collect()}
    alone = bt.run_backtest(demand, [ml.ModelPredictor("p", FEATURES, params, "poisson_trees")], 2, HOUR).collect()
    assert len(got) == 2 and all(math.isclose(got[r.window], r.mae, rel_tol=1e-9) for r in alone)


def test_poisson_artifacts_come_back_and_need_two_months(spark, tmp_path, demand):
    from tallycast.config import DEFAULT
    cfg = DEFAULT.with_(tree_params={"n_estimators": 3, "num_leaves": 4})
    art = ml.train_production(demand, cfg, f"{tmp_path}/m", dt.date(2025, 3, 31), "poisson_trees", FEATURES)
    back = ml.load_artifact(spark, f"{tmp_path}/m")
    some = demand.where("hour >= '2025-04-20'")
    assert sorted(map(tuple, art.score(some).select("station_id", "hour", "prediction").collect())) == sorted(
        map(tuple, back.score(some).select("station_id", "hour", "prediction").collect()))
    assert back.metadata["train_through"].startswith("2025-03-31") and back.metadata["categories"] == {"station_id": ["A", "B"]}
    assert back.metadata["fitted_n_estimators"] == len(back.model.trees) >= 1 and back.metadata["val_mae"] > 0
    assert ml.feature_importance(back.model, FEATURES).first().importance > 0
    with pytest.raises(ValueError, match="two calendar months"):
        ml.fit_model(demand.where("hour >= '2025-04-01'"), FEATURES, {}, "poisson_trees")
