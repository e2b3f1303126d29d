"""Experiment harness: feature variants, one-knob parameter sweeps and an
append-only run table that feeds a leaderboard."""

from __future__ import annotations

import datetime as dt
import json
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import Grain
from ..sources.paths import has_data
from . import backtest as bt
from . import poisson_trees as pt
from .models import KEY, ModelPredictor, usable_rows, window_rows, window_specs

RUN_SCHEMA = ("run_id string, run_name string, candidate string, params string, predictor string, "
              "window string, mae double, rmse double, n bigint, logged_at string")


def drop_features(features: list[str], removed) -> list[str]:
    removed = set(removed)
    return [f for f in features if f not in removed]


def sweep_candidates(base: dict, grid: dict[str, list]) -> list[tuple[str, dict]]:
    """Base plus one knob changed at a time (override merged over base)."""
    out = [("base", dict(base))]
    for knob, values in grid.items():
        for v in values:
            if base.get(knob) != v:
                out.append((f"{knob}={v}", {**base, knob: v}))
    return out


def log_run(results: DataFrame, runs_path: str, run_name: str, candidate: str, params: dict) -> str:
    """Append the per-window metric rows of one run to the run table."""
    run_id = uuid.uuid4().hex[:12]
    (results.select(F.lit(run_id).alias("run_id"), F.lit(run_name).alias("run_name"),
                    F.lit(candidate).alias("candidate"), F.lit(json.dumps(params, sort_keys=True)).alias("params"),
                    "predictor", "window", "mae", "rmse", "n",
                    F.lit(dt.datetime.now(dt.timezone.utc).isoformat()).alias("logged_at"))
     .write.mode("append").parquet(runs_path))
    return run_id


def run_sweep(features: DataFrame, feature_list: list[str], base: dict, grid: dict, n_windows: int, grain: Grain,
              runs_path: str, run_name: str, kind: str = "gbt") -> None:
    for name, params in sweep_candidates(base, grid):
        res = bt.run_backtest(features, [ModelPredictor(name, feature_list, params, kind), bt.SeasonalNaive(grain)], n_windows, grain)
        log_run(res, runs_path, run_name, name, params)


def logged_fits(spark, runs_path: str, run_name: str) -> set[tuple[str, str, str]]:
    """(candidate, params, window) of the fits that a run has logged: one row per fit."""
    if not has_data(spark, runs_path):
        return set()
    r = spark.read.schema(RUN_SCHEMA).parquet(runs_path).where(F.col("run_name") == run_name)
    return {tuple(x) for x in r.where(F.col("predictor") == F.col("candidate")).select("candidate", "params", "window").distinct().collect()}


def run_grid(features: DataFrame, candidates: dict[str, tuple[list[str], dict]], n_windows: int, grain: Grain, runs_path: str, run_name: str,
             together: int = 16, baselines: list | None = None) -> int:
    """Fits every candidate (feature list, tree parameters) on every window and
    logs one metric row each, keyed on (run, candidate, window); returns the
    number of fits made.

    Fits already logged under ``run_name`` are skipped, so a run that was cut
    short goes on where it stopped. ``together`` fits share their passes over the
    rows; their models score their windows in one job, which appends to the log.
    The ``baselines`` (seasonal naive unless given) are logged once a run.
    """
    spark = features.sparkSession
    windows = bt.window_table(features, n_windows, grain)
    done = logged_fits(spark, runs_path, run_name)
    todo = [(name, params, w, s) for name, (flist, params) in candidates.items()
            for w, s in window_specs(features, windows, name, flist, params).items()
            if (name, _params_text(flist, params), w) not in done]
    if not has_data(spark, runs_path) or not spark.read.schema(RUN_SCHEMA).parquet(runs_path).where((F.col("run_name") == run_name) & (F.col("candidate") == "")).take(1):
        own = bt.run_backtest(features, baselines or [bt.SeasonalNaive(grain)], n_windows, grain)
        _append(own.select("predictor", "window", "mae", "rmse", "n", F.lit("").alias("candidate"), F.lit("{}").alias("params")), runs_path, run_name)
    every = list(dict.fromkeys(f for flist, _ in candidates.values() for f in flist))
    rows = usable_rows(features, every)
    for i in range(0, len(todo), together):
        group = todo[i:i + together]
        scored = None
        for (name, params, w, spec), model in zip(group, pt.fit_many(rows, [g[3] for g in group])):
            d = model.score(window_rows(features, w)).select(F.lit(name).alias("predictor"), F.lit(w).alias("window"), KEY, "trips", "prediction",
                                                             F.lit(name).alias("candidate"), F.lit(_params_text(list(spec.features), params)).alias("params"))
            scored = d if scored is None else scored.unionByName(d)
        _append(bt.metrics(scored, ["predictor", "window", "candidate", "params"]), runs_path, run_name)
    return len(todo)


def _params_text(feature_list: list[str], params: dict) -> str:
    return json.dumps({**params, "features": feature_list}, sort_keys=True)


def _append(results: DataFrame, runs_path: str, run_name: str) -> None:
    """Metric rows of a run, whose name is its id, in one append."""
    (results.select(F.lit(run_name).alias("run_id"), F.lit(run_name).alias("run_name"), "candidate", "params", "predictor", "window", "mae", "rmse", "n",
                    F.lit(dt.datetime.now(dt.timezone.utc).isoformat()).alias("logged_at")).coalesce(1)
     .write.mode("append").parquet(runs_path))


def leaderboard(runs: DataFrame, run_prefix: str | None = None, naive: str = "seasonal_naive") -> DataFrame:
    """Mean / std MAE, mean RMSE and mean MASE per (candidate, run), the naive
    predictor's rows apart; null metrics dropped; sorted by MAE. MASE is null
    where a run has no naive row for a window."""
    r = runs if run_prefix is None else runs.where(F.col("run_name").startswith(run_prefix))
    base = r.where(F.col("predictor") == naive).groupBy(F.col("run_id").alias("_r"), F.col("window").alias("_w")).agg(F.avg("mae").alias("_naive"))
    own = r.where((F.col("predictor") != naive) & (F.col("candidate") != "")).join(base, (F.col("run_id") == F.col("_r")) & (F.col("window") == F.col("_w")), "left")
    return (own.groupBy("candidate", "run_id", "params").agg(
        F.avg("mae").alias("mae_mean"), F.stddev_samp("mae").alias("mae_std"), F.avg("rmse").alias("rmse_mean"),
        F.avg(F.try_divide("mae", "_naive")).alias("mase_mean"))
        .dropna(subset=["mae_mean"]).orderBy("mae_mean", "candidate"))


def compare_variants(features: DataFrame, variants: dict[str, list[str]], params: dict, n_windows: int,
                     grain: Grain, kind: str = "gbt") -> DataFrame:
    """Same windows, one feature list per variant; one summary row per variant."""
    preds = [ModelPredictor(name, flist, params, kind) for name, flist in variants.items()]
    res = bt.run_backtest(features, preds + [bt.SeasonalNaive(grain)], n_windows, grain)
    return bt.summarize(res, digits=6)


def select_run(runs: DataFrame, prefix: str) -> DataFrame:
    """The single run whose name starts with ``prefix``; zero or several -> error."""
    ids = runs.where(F.col("run_name").startswith(prefix)).select("run_id").distinct().limit(2).collect()
    if len(ids) != 1:
        raise ValueError(f"expected exactly one run starting with {prefix!r}, found {len(ids)}")
    return runs.where(F.col("run_id") == ids[0][0])
