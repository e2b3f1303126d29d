import dataclasses
import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallycast.operators import features
from tallycast.operators import poisson_trees as pt
from tallycast.plans import queries
from tallycast.plans.pipelines import DAY_CFG


@pytest.fixture
def fits(spark, monkeypatch):
    """Day features of two stations for the registered queries; the specs that they fit, of which three trees are grown."""
    rng, start = np.random.default_rng(3), dt.datetime(2025, 1, 1)
    rows = [(k, start + dt.timedelta(days=i), int(rng.poisson(2 + i % 7))) for k in "AB" for i in range(300)]
    f = spark.createDataFrame(rows, "station_id string, hour timestamp_ntz, trips int")
    f = features.add_lag_features(features.add_calendar_features(f), DAY_CFG.grain)
    f = f.withColumns({c: (F.col("trips") * 0 + 1).cast("double") for c in [*DAY_CFG.covariates, "lat", "lng"]}).persist()
    seen, real = [], pt.fit_many

    def few(rows, specs, **kw):
        seen.extend(specs)
        return real(rows, [dataclasses.replace(s, params={**s.params, "n_estimators": 3}) for s in specs], **kw)
    monkeypatch.setattr(pt, "fit_many", few)
    monkeypatch.setattr(queries, "day_features", lambda spark, sf: f)
    return seen


def test_the_artifact_is_fitted_with_the_configured_parameters(spark, fits):
    got = queries.q_artifact_bt(spark, "own rows of the artifact").collect()
    assert {r.predictor for r in got} == {"current", "seasonal_naive"}
    assert all(r.n > 0 for r in got)
    chosen, refit = (s.param() for s in fits)
    assert {k: chosen[k] for k in ("n_estimators", "learning_rate", "num_leaves", "early_stopping")} == {
        "n_estimators": 2000, "learning_rate": 0.05, "num_leaves": 63, "early_stopping": 50}
    assert chosen["max_depth"] == pt.DEFAULTS["max_depth"] and refit | {"n_estimators": 2000} == chosen


def test_the_sweep_fits_its_500_trees_on_every_window(spark, fits):
    board = queries.q_sweep(spark, "own rows of the sweep").collect()
    assert len(board) == 9 and len(fits) == 9 * DAY_CFG.n_windows
    assert {(p["n_estimators"], p["early_stopping"], p["max_depth"]) for p in (s.param() for s in fits)} == {(500, 50, pt.DEFAULTS["max_depth"])}
    changed = {k: {s.param()[k] for s in fits} for k in ("learning_rate", "num_leaves", "min_child_samples")}
    assert changed == {"learning_rate": {0.03, 0.05, 0.1}, "num_leaves": {31, 63, 127}, "min_child_samples": {20, 100, 500}}
