"""Registered queries: name -> (spark, sf_dir) -> DataFrame.

Every query reads the driver's tables through ``adapters`` so its work grows
with them. Float outputs are rounded to 6 decimals after the last aggregation
so that the DuckDB oracle can compare value hashes.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.calendar import holiday_calendar
from ..functions.exprs import materialize, round6
from ..operators import cleaning, events, features, grid
from ..sources import sinks
from . import adapters
from .pipelines import (DAY_CFG, HOUR_CFG, day_backtest_base, day_baselines, day_clean, day_covariates,
                        day_features, day_grid, day_master, hour_clean, hour_covariates, hour_features,
                        hour_grid, hour_grid_phased, day_grid_phased, hour_master, hour_scope, product)

REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def register(name: str):
    def deco(fn):
        REGISTRY[name] = fn
        return fn
    return deco


# ---------------------------------------------------------------- flagship
@register("naive_mae_by_hour")
def naive_mae_by_hour(spark, sf):
    """events -> counts -> dense grid -> calendar -> lags -> seasonal naive ->
    MAE per hour of day."""
    f = features.add_lag_features(features.add_calendar_features(hour_grid_phased(spark, sf)), HOUR_CFG.grain)
    pred = F.coalesce(F.col("lag_168"), F.lit(0)).cast("double")
    return round6(f.groupBy("hour_of_day").agg(
        F.avg(F.abs(F.col("trips") - pred)).alias("mae"), F.count(F.lit(1)).alias("n")))


# ---------------------------------------------------------------- cleaning
@register("removal_report")
def q_removal_report(spark, sf):
    return cleaning.removal_report(adapters.events_trips(spark, sf), HOUR_CFG)


@register("removal_report_daily")
def q_removal_report_daily(spark, sf):
    return cleaning.removal_report(adapters.orders_trips(spark, sf), DAY_CFG)


@register("clean_trips")
def q_clean_trips(spark, sf):
    return hour_clean(spark, sf)


# ---------------------------------------------------------------- grid
@register("top_n_scope")
def q_top_n_scope(spark, sf):
    return grid.select_scope(hour_clean(spark, sf), HOUR_CFG.top_n, HOUR_CFG.scope_lookback_days)


@register("series_hour_counts")
def q_series_hour_counts(spark, sf):
    return grid.series_counts(hour_clean(spark, sf), hour_scope(spark, sf), HOUR_CFG.grain)


@register("full_grid")
def q_full_grid(spark, sf):
    return hour_grid(spark, sf, trim=False)


@register("grid_identity")
def q_grid_identity(spark, sf):
    return grid.grid_identity(hour_grid(spark, sf, trim=False))


@register("trim_to_lifetime")
def q_trim(spark, sf):
    return day_grid(spark, sf, trim=True)


@register("station_master")
def q_station_master(spark, sf):
    return round6(hour_master(spark, sf))


@register("station_month_panel")
def q_panel(spark, sf):
    return grid.station_month_panel(day_clean(spark, sf))


# ---------------------------------------------------------------- calendar
@register("calendar_features")
def q_calendar(spark, sf):
    return round6(features.add_calendar_features(day_grid(spark, sf)))


@register("holiday_flag")
def q_holidays(spark, sf):
    o = adapters.table(spark, sf, "orders")
    yrs = o.agg(F.year(F.min("o_orderdate")).alias("a"), F.year(F.max("o_orderdate")).alias("b"))
    return holiday_calendar(spark, yrs.select("a").scalar(), yrs.select("b").scalar())


@register("event_flag")
def q_event_flag(spark, sf):
    days = events.event_days(adapters.event_calendar(spark))
    return events.add_event_feature(day_grid(spark, sf), days)


@register("event_coverage")
def q_event_coverage(spark, sf):
    days = events.event_days(adapters.event_calendar(spark))
    return round6(events.event_coverage(events.add_event_feature(day_grid(spark, sf), days)))


# ---------------------------------------------------------------- covariates and lags
@register("covariate_join")
def q_cov(spark, sf):
    g = hour_grid(spark, sf)
    return round6(features.add_covariates(g, hour_covariates(spark, sf), HOUR_CFG))


@register("covariate_match_rate")
def q_cov_rate(spark, sf):
    g = hour_grid(spark, sf)
    j = g.join(hour_covariates(spark, sf).withColumnRenamed("timestamp", "hour"), "hour", "left")
    return round6(j.agg(F.count(F.lit(1)).alias("total"), F.count("temperature_2m").alias("matched"))
                  .withColumn("match_rate", F.col("matched") / F.col("total"))
                  .withColumn("passed", F.col("match_rate") >= HOUR_CFG.min_covariate_match))


@register("station_features")
def q_station_features(spark, sf):
    return round6(features.add_station_features(hour_grid(spark, sf), hour_master(spark, sf), HOUR_CFG))


@register("lag_features")
def q_lags(spark, sf):
    return round6(features.add_lag_features(hour_grid_phased(spark, sf), HOUR_CFG.grain).drop("hour_of_day"))


@register("lag_features_daily")
def q_lags_daily(spark, sf):
    return round6(features.add_lag_features(day_grid_phased(spark, sf), DAY_CFG.grain).drop("day_of_week"))


@register("feature_product")
def q_feature_product(spark, sf):
    """The feature table as a named product, one partition a month: written,
    its last month written again, read back month by month."""
    from .pipelines import shared_dir

    root, f = shared_dir(spark, "products"), hour_features(spark, sf)
    sinks.write_product(f, root, "features")
    months = [r[0] for r in f.select(F.date_format("hour", "yyyy-MM")).distinct().orderBy(F.desc("date_format(hour, yyyy-MM)")).collect()]
    sinks.write_product(f.where(F.date_format("hour", "yyyy-MM") == months[0]), root, "features")
    return round6(sinks.read_product(spark, root, "features", months))


@register("feature_table")
def q_feature_table(spark, sf):
    return round6(hour_features(spark, sf))


# ---------------------------------------------------------------- backtest (day grain on orders)
from ..operators import backtest as bt  # noqa: E402
from ..operators import errors as er  # noqa: E402


@register("eval_months")
def q_eval_months(spark, sf):
    return bt.eval_months(day_grid(spark, sf), DAY_CFG.n_windows, DAY_CFG.grain)


@register("eval_months_hourly")
def q_eval_months_hourly(spark, sf):
    """Events cover 30 days of one month: no complete month, so no window."""
    return bt.eval_months(hour_grid(spark, sf), HOUR_CFG.n_windows, HOUR_CFG.grain)


@register("backtest_naive")
def q_bt_naive(spark, sf):
    f = day_backtest_base(spark, sf)
    return round6(bt.run_backtest(f, [bt.SeasonalNaive(DAY_CFG.grain)], DAY_CFG.n_windows, DAY_CFG.grain))


@register("backtest_hist_mean")
def q_bt_hist(spark, sf):
    f = day_backtest_base(spark, sf)
    return round6(bt.run_backtest(f, [bt.HistoricalMean()], DAY_CFG.n_windows, DAY_CFG.grain))


@register("backtest_hist_mean_16w")
def q_bt_hist_16w(spark, sf):
    f = day_backtest_base(spark, sf)
    return round6(bt.run_backtest(f, [bt.HistoricalMean(16)], DAY_CFG.n_windows, DAY_CFG.grain))


@register("backtest_summary")
def q_bt_summary(spark, sf):
    f = day_backtest_base(spark, sf)
    res = bt.run_backtest(f, day_baselines(), DAY_CFG.n_windows, DAY_CFG.grain)
    return bt.summarize(res, digits=6)


@register("prediction_table")
def q_pred_table(spark, sf):
    f = day_backtest_base(spark, sf)
    return round6(bt.prediction_table(f, day_baselines(), None, DAY_CFG.grain, DAY_CFG.n_windows))


def _err(spark, sf):
    def build():
        f = day_backtest_base(spark, sf)
        p = bt.prediction_table(f, day_baselines(), None, DAY_CFG.grain, DAY_CFG.n_windows)
        return er.error_table(p, "pred_historical_mean")
    return product(spark, sf, "day_error_table", build)


@register("error_overall")
def q_err_overall(spark, sf):
    return round6(er.overall_error(_err(spark, sf)))


@register("error_by_weekday")
def q_err_weekday(spark, sf):
    from ..functions.calendar import iso_dow
    return round6(er.error_slice(_err(spark, sf), iso_dow(F.col("hour")).alias("day_of_week")))


@register("error_by_weekend")
def q_err_weekend(spark, sf):
    return round6(er.by_weekend(_err(spark, sf)))


@register("error_by_rain")
def q_err_rain(spark, sf):
    return round6(er.by_rain(_err(spark, sf), day_covariates(spark, sf), 0.5))


@register("error_by_series")
def q_err_series(spark, sf):
    return round6(er.by_series(_err(spark, sf), day_master(spark, sf)))


@register("error_by_day")
def q_err_day(spark, sf):
    return round6(er.by_day(_err(spark, sf)))


@register("peak_bias")
def q_peak_bias(spark, sf):
    return round6(er.peak_bias(_err(spark, sf), "pred_historical_mean", 0.95))


@register("worst_k_series")
def q_worst_k(spark, sf):
    s = er.error_slice(_err(spark, sf), "station_id")
    return round6(er.worst_k(s, "mae_model", 5, tie="station_id"))


@register("best_days")
def q_best_days(spark, sf):
    """The five days on which the model errs least, the other end of the same ranking."""
    return round6(er.worst_k(er.by_day(_err(spark, sf)), "mae_model", 5, ascending=True, tie="date"))


@register("error_by_hour")
def q_err_hour(spark, sf):
    """Error slices by hour of day at hour grain: the same hour's mean of the last week against the weekly lag."""
    f = hour_features(spark, sf).where("lag_168 IS NOT NULL AND roll_mean_7d IS NOT NULL")
    p = f.select("station_id", "hour", "trips", F.col("lag_168").cast("double").alias("pred_seasonal_naive"), F.col("roll_mean_7d").alias("pred_same_hour"))
    return round6(er.by_hour(er.error_table(p, "pred_same_hour")))


@register("model_error_by_weekend")
def q_model_err(spark, sf):
    """Error slices of the saved, fitted model on the months after its cutoff."""
    art, f = _artifact(spark, sf), day_features(spark, sf)
    cut = _dt.datetime.fromisoformat(art.metadata["train_through"])
    after = f.where((F.col("hour") > F.lit(cut)) & F.col(DAY_CFG.grain.naive_lag).isNotNull())
    p = art.score(after).withColumn("pred_seasonal_naive", F.col(DAY_CFG.grain.naive_lag).cast("double"))
    return er.by_weekend(er.error_table(p, "prediction"))


# ---------------------------------------------------------------- profiles
from ..operators import profile as pr  # noqa: E402


@register("raw_overview")
def q_raw_overview(spark, sf):
    return pr.raw_overview(adapters.events_trips(spark, sf))


@register("clean_overview")
def q_clean_overview(spark, sf):
    return pr.clean_overview(hour_clean(spark, sf))


@register("monthly_demand")
def q_monthly(spark, sf):
    return pr.monthly_demand(adapters.orders_trips(spark, sf))


@register("peak_low_month")
def q_peak_low(spark, sf):
    return pr.peak_and_low_month(adapters.orders_trips(spark, sf))


@register("quality_summary")
def q_quality(spark, sf):
    return round6(pr.quality_summary(adapters.events_trips(spark, sf)))


@register("duration_histogram")
def q_hist(spark, sf):
    return round6(pr.duration_histogram(adapters.events_trips(spark, sf)))


@register("hourly_profile")
def q_hourly_profile(spark, sf):
    return pr.hourly_profile(hour_clean(spark, sf))


@register("weekday_hour_pivot")
def q_wh_pivot(spark, sf):
    return pr.weekday_hour_pivot(hour_clean(spark, sf))


@register("type_hourly")
def q_type_hourly(spark, sf):
    return pr.type_hourly(hour_clean(spark, sf))


@register("system_hourly")
def q_system_hourly(spark, sf):
    return pr.system_hourly(hour_clean(spark, sf))


@register("system_match_rate")
def q_sys_match(spark, sf):
    return round6(pr.system_match_rate(hour_clean(spark, sf), hour_covariates(spark, sf)))


@register("mean_by_hour_of_day")
def q_mean_hod(spark, sf):
    return round6(pr.mean_by_hour_of_day(hour_clean(spark, sf)))


def _sw(spark, sf):
    return pr.system_with_covariates(hour_clean(spark, sf), hour_covariates(spark, sf))


@register("temp_bins")
def q_temp_bins(spark, sf):
    return round6(pr.temperature_bins(_sw(spark, sf)))


@register("rain_effect")
def q_rain(spark, sf):
    return round6(pr.rain_effect(_sw(spark, sf)))


@register("snow_effect")
def q_snow(spark, sf):
    return round6(pr.snow_effect(_sw(spark, sf)))


@register("zero_inflation")
def q_zero(spark, sf):
    return round6(pr.zero_inflation(day_grid(spark, sf)))


@register("zero_inflation_monthly")
def q_zero_m(spark, sf):
    return round6(pr.zero_inflation(day_grid(spark, sf), by_month=True))


@register("cum_share_rank")
def q_cum_share(spark, sf):
    return round6(pr.volume_ranking(hour_clean(spark, sf)))


@register("rank_for_share")
def q_rank_for(spark, sf):
    return round6(pr.share_at_and_rank_for(pr.volume_ranking(hour_clean(spark, sf)), 0.65, (10, 20, 50, 100)))


@register("shift_sanity")
def q_shift(spark, sf):
    return pr.shift_sanity(hour_clean(spark, sf))


@register("coordinate_quality")
def q_coord(spark, sf):
    return pr.coordinate_quality(hour_master(spark, sf))


# ---------------------------------------------------------------- spatial de-duplication
from ..operators import spatial as sp  # noqa: E402


def _pairs(spark, sf):
    return product(spark, sf, "near_pairs", lambda: sp.near_pairs(adapters.spatial_stations(spark, sf)))


@register("near_pairs")
def q_near_pairs(spark, sf):
    return _pairs(spark, sf)


@register("duplicate_edges")
def q_dup_edges(spark, sf):
    return sp.duplicate_edges(_pairs(spark, sf))


@register("flatten_mapping")
def q_flatten(spark, sf):
    return sp.flatten_mapping(sp.duplicate_edges(_pairs(spark, sf)))


@register("mapping_guards")
def q_guards(spark, sf):
    return sp.mapping_guards(sp.flatten_mapping(sp.duplicate_edges(_pairs(spark, sf))))


@register("supplier_mapping_guards")
def q_sup_guards(spark, sf):
    return sp.mapping_guards(adapters.supplier_mapping(spark, sf))


# ---------------------------------------------------------------- clustering
from ..operators import clustering as cl  # noqa: E402


@register("station_profiles")
def q_profiles(spark, sf):
    return round6(cl.station_profiles(hour_grid(spark, sf)))


def _clusters(spark, sf):
    return product(spark, sf, "clusters", lambda: cl.cluster_stations(cl.station_profiles(hour_grid(spark, sf)),
                                                                      k=5, seed=42))


@register("cluster_stations")
def q_clusters(spark, sf):
    return _clusters(spark, sf)


@register("cluster_feature")
def q_cluster_feature(spark, sf):
    return cl.add_cluster_feature(hour_grid(spark, sf), _clusters(spark, sf))


# ---------------------------------------------------------------- serving and monitoring (hour grain)
import datetime as _dt  # noqa: E402

from ..operators import drift as dr  # noqa: E402
from ..operators import forecast as fc  # noqa: E402
from ..operators import gates as gt  # noqa: E402
from ..operators.models import NaiveArtifact  # noqa: E402
from .pipelines import hour_replay_days, hour_store, shared_dir  # noqa: E402
from ..operators import serving_state as st  # noqa: E402


@register("history_coverage")
def q_hist_cov(spark, sf):
    d = hour_replay_days(spark, sf)[-1]
    return fc.history_coverage(hour_grid(spark, sf), d, HOUR_CFG.grain)


@register("inference_features")
def q_inference(spark, sf):
    d = hour_replay_days(spark, sf)[-1]
    return round6(fc.build_inference_features(hour_grid(spark, sf), hour_covariates(spark, sf),
                                              hour_master(spark, sf), d, HOUR_CFG))


def _store(spark, sf):
    return fc.read_store(spark, hour_store(spark, sf))


@register("batch_forecast")
def q_batch(spark, sf):
    return round6(_store(spark, sf).drop("created_at"))


@register("forecast_eval")
def q_fc_eval(spark, sf):
    detail = fc.prediction_actual_table(_store(spark, sf), hour_grid(spark, sf))
    return round6(fc.evaluate_predictions(detail))


@register("forecast_unmatched")
def q_fc_unmatched(spark, sf):
    return _store(spark, sf).drop("created_at").transform(lambda s: fc.unmatched_forecasts(s, hour_grid(spark, sf)))


def _replayed(spark, sf):
    frame = fc.replay_inference_features(hour_grid(spark, sf), hour_replay_days(spark, sf), HOUR_CFG)
    preds = NaiveArtifact(HOUR_CFG.grain.naive_lag).score(frame).drop("trips")
    return fc.evaluate_predictions(fc.prediction_actual_table(preds, hour_grid(spark, sf)))


@register("replay_mae")
def q_replay(spark, sf):
    return round6(_replayed(spark, sf))


@register("store_health")
def q_store_health(spark, sf):
    return fc.store_health(_store(spark, sf))


@register("forecast_lookup")
def q_lookup(spark, sf):
    s = _store(spark, sf)
    key = s.agg(F.min("station_id")).first()[0]
    return fc.forecast_lookup(s, key)


@register("forecast_scope")
def q_fc_scope(spark, sf):
    return fc.newest_scope(_store(spark, sf), hour_scope(spark, sf).select("station_id"))


def _drift_frames(spark, sf):
    f = hour_features(spark, sf)
    last = f.agg(F.max("hour")).first()[0]
    cur_start = _dt.datetime.combine(last.date() - _dt.timedelta(days=6), _dt.time())
    ref = f.where(F.col("hour") < F.lit(cur_start))
    cur = f.where(F.col("hour") >= F.lit(cur_start))
    return ref, cur


@register("drift_statistics")
def q_drift_stats(spark, sf):
    ref, cur = _drift_frames(spark, sf)
    cols = dr.usable_columns(ref, cur)
    return round6(dr.drift_statistics(ref, cur, cols))


@register("drift_from_days")
def q_drift_days(spark, sf):
    """The same statistics from histograms that were stored day by day, in two
    runs of which the second finds the first one's days counted."""
    f = hour_features(spark, sf)
    first, last = (r.date() for r in f.agg(F.min("hour"), F.max("hour")).first())
    days = [first + _dt.timedelta(days=i) for i in range((last - first).days + 1)]
    path, split = shared_dir(spark, "histograms"), last - _dt.timedelta(days=6)
    dr.record_days(f, path, days[:len(days) // 2])
    if dr.record_days(f, path, days) != days[len(days) // 2:]:
        raise AssertionError("a day was counted twice")
    return round6(dr.drift_of_days(spark, path, (first, split - _dt.timedelta(days=1)), (split, last)))


@register("drift_gate")
def q_drift_gate(spark, sf):
    ref, cur = _drift_frames(spark, sf)
    return round6(dr.drift_gate(ref, cur, 0.5))


def _baseline_mae(spark, sf):
    """Seasonal-naive MAE over the week before the first served day."""
    first = hour_replay_days(spark, sf)[0] + _dt.timedelta(days=1)
    start = _dt.datetime.combine(first - _dt.timedelta(days=7), _dt.time())
    f = features.add_lag_features(hour_grid_phased(spark, sf), HOUR_CFG.grain)
    w = f.where((F.col("hour") >= F.lit(start)) & (F.col("hour") < F.lit(_dt.datetime.combine(first, _dt.time()))))
    return w.agg(F.avg(F.abs(F.col("trips") - F.coalesce(F.col("lag_168"), F.lit(0))))).first()[0]


@register("performance_gate")
def q_perf_gate(spark, sf):
    daily = fc.evaluate_predictions(fc.prediction_actual_table(_store(spark, sf), hour_grid(spark, sf)))
    return gt.performance_gate(daily, _baseline_mae(spark, sf), 0.20)


@register("leakage_gate")
def q_leakage_gate(spark, sf):
    """Every count after a day is changed; the lag features up to one horizon later must not notice."""
    cut = _dt.datetime.combine(hour_replay_days(spark, sf)[0], _dt.time(23))
    return gt.leakage_gate(hour_grid(spark, sf), HOUR_CFG.grain, cut)


@register("state_inference_features")
def q_state_features(spark, sf):
    """The coming day's features from the committed per-phase state: initialised
    one day earlier, advanced by one day's counts, read back."""
    before, as_of = hour_replay_days(spark, sf)
    path, hist, cov, master = shared_dir(spark, "state"), hour_grid(spark, sf), hour_covariates(spark, sf), hour_master(spark, sf)
    st.commit_state(st.initial_state(hist, before, HOUR_CFG.grain), path, before)
    _, state = st.read_state(spark, path)
    st.commit_state(st.advance(state, hist.where(F.to_date("hour") == F.lit(as_of)), as_of, HOUR_CFG.grain), path, as_of)
    day, state = st.read_state(spark, path)
    return round6(st.state_features(state, day, HOUR_CFG, cov, master))


@register("replay_summary")
def q_replay_summary(spark, sf):
    """Mean MAE of the replayed days and its difference to the naive baseline of the week before."""
    return round6(fc.replay_summary(_replayed(spark, sf), _baseline_mae(spark, sf)))


@register("monitoring_summary")
def q_monitoring(spark, sf):
    art = NaiveArtifact(HOUR_CFG.grain.naive_lag)
    meta = dict(art.metadata, val_mae=_baseline_mae(spark, sf),
                train_through=str(_dt.datetime.combine(hour_replay_days(spark, sf)[0], _dt.time(23))))
    summary, perf, drift = gt.run_monitoring(hour_features(spark, sf), _store(spark, sf), meta)
    one = lambda g, name: g.select(F.lit(1).alias("k"), F.col("passed").alias(name))
    return summary.withColumn("k", F.lit(1)).join(one(perf, "performance_passed"), "k").join(one(drift, "drift_passed"), "k").drop("k")


# ---------------------------------------------------------------- models, experiments, promotion (day grain)
from ..operators import experiments as ex  # noqa: E402
from ..operators import models as ml  # noqa: E402
from ..operators import promote as pm  # noqa: E402
from ..sources import dimensions  # noqa: E402

# trees of a fit of poisson_trees_forecast and ablation; the artifact takes the configured 2,000 and 50, the sweep its own cap
_TREES = {**DAY_CFG.tree_params, "n_estimators": 10, "max_depth": 7}
_GBT = {"max_iter": 20, "max_depth": 4, "step_size": 0.2}


def _day_feats_events(spark, sf):
    return product(spark, sf, "day_features_events", lambda: events.add_event_feature(
        day_features(spark, sf), events.event_days(adapters.event_calendar(spark))))


def _model_backtest(spark, sf, name, kind, params):
    f = day_features(spark, sf)
    p = ml.ModelPredictor(name, DAY_CFG.model_features, params, kind)
    return bt.run_backtest(f, [p, bt.SeasonalNaive(DAY_CFG.grain)], DAY_CFG.n_windows, DAY_CFG.grain)


@register("poisson_trees_forecast")
def q_poisson_trees(spark, sf):
    """Boosted trees with Poisson loss over all evaluation windows, fitted together."""
    return _model_backtest(spark, sf, "poisson_trees", "poisson_trees", _TREES)


@register("gbt_forecast")
def q_gbt(spark, sf):
    return _model_backtest(spark, sf, "gbt", "gbt", _GBT)


@register("poisson_glm_forecast")
def q_glm(spark, sf):
    return _model_backtest(spark, sf, "poisson_glm", "glm", {"max_iter": 25})


def _artifact(spark, sf):
    key = (spark.sparkContext.applicationId, sf, "day_artifact")
    from .pipelines import _PRODUCTS
    if key not in _PRODUCTS:
        f = day_features(spark, sf)
        # the end of the month before the evaluation windows
        first = bt.window_table(f, DAY_CFG.n_windows, DAY_CFG.grain).orderBy("window").first()
        _PRODUCTS[key] = ml.train_production(f, DAY_CFG, shared_dir(spark, "artifact"), first["cutoff"].date(), "poisson_trees")
    return _PRODUCTS[key]


@register("feature_importance")
def q_importance(spark, sf):
    art = _artifact(spark, sf)
    return ml.feature_importance(art.model, art.metadata["features"])


@register("artifact_scoring")
def q_artifact_scoring(spark, sf):
    """Reload the saved artifact and score the rows after its cutoff."""
    art = _artifact(spark, sf)
    loaded = ml.load_artifact(spark, _artifact_dir(art))
    cut = _dt.datetime.fromisoformat(loaded.metadata["train_through"])
    rows = day_features(spark, sf).where(F.col("hour") > F.lit(cut))
    return loaded.score(rows).select("station_id", "hour", "trips", "prediction")


def _artifact_dir(art):
    return art.metadata["path"]


@register("sweep_leaderboard")
def q_sweep(spark, sf):
    """Nine candidates, one knob changed each, of up to the sweep's 500 trees over all
    evaluation windows; the run is started a second time and finds every fit in the log."""
    f, runs = day_features(spark, sf), shared_dir(spark, "runs")
    knobs = {"learning_rate": (0.03, 0.05, 0.10), "num_leaves": (31, 63, 127), "min_child_samples": (20, 100, 500)}
    base, params = DAY_CFG.model_features, {**DAY_CFG.tree_params, "n_estimators": DAY_CFG.sweep_estimators}
    candidates = {f"{k}={v}": (base, {**params, k: v}) for k, values in knobs.items() for v in values}
    ex.run_grid(f, candidates, DAY_CFG.n_windows, DAY_CFG.grain, runs, "sweep-trees", together=36)
    if ex.run_grid(f, candidates, DAY_CFG.n_windows, DAY_CFG.grain, runs, "sweep-trees"):
        raise AssertionError("logged fits were made again")
    return ex.leaderboard(spark.read.parquet(runs), "sweep")


@register("ablation")
def q_ablation(spark, sf):
    """The feature variants: none, without covariates, event flag, demand-shape
    cluster (from the months before the first evaluation window)."""
    f = _day_feats_events(spark, sf)
    first = bt.window_table(f, DAY_CFG.n_windows, DAY_CFG.grain).orderBy("window").first()["window"]
    before = f.where(F.col("hour") < F.lit(_dt.datetime.strptime(first, "%Y-%m"))).select("station_id", "hour", "trips")
    f = materialize(cl.add_cluster_feature(f, cl.cluster_stations(cl.station_profiles(before))), "table")
    base, runs = DAY_CFG.model_features, shared_dir(spark, "variants")
    variants = {"base": base, "no_weather": ex.drop_features(base, DAY_CFG.covariates), "event_flag": base + ["is_major_event"], "cluster": base + ["cluster"]}
    ex.run_grid(f, {name: (flist, _TREES) for name, flist in variants.items()}, DAY_CFG.n_windows, DAY_CFG.grain, runs, "variants",
                baselines=day_baselines())
    return bt.summarize(spark.read.parquet(runs).select("predictor", "window", "mae", "rmse", "n"), digits=6)


def _champion_meta(spark, sf):
    """Champion (seasonal naive) 'trained' through the end of the month three
    months before the last full month of the day grid."""
    months = [r[0] for r in bt.eval_months(day_grid(spark, sf), 4, DAY_CFG.grain).orderBy("window").collect()]
    first = _dt.date.fromisoformat(months[0] + "-01") - _dt.timedelta(days=1)
    return {"model_version": "seasonal-naive-v1", "train_through": f"{first.isoformat()} 00:00:00"}


@register("unseen_full_month")
def q_unseen(spark, sf):
    meta = _champion_meta(spark, sf)
    return pm.unseen_full_month(day_grid(spark, sf), _dt.datetime.fromisoformat(meta["train_through"]), DAY_CFG.grain)


@register("promotion_decision")
def q_promote(spark, sf):
    meta = _champion_meta(spark, sf)
    return round6(pm.promote_if_better(day_backtest_base(spark, sf), bt.SeasonalNaive(DAY_CFG.grain),
                                       bt.HistoricalMean(), meta, DAY_CFG.grain, 0.02))


@register("current_model")
def q_current_model(spark, sf):
    """Two real decisions are recorded, seasonal naive against historical mean
    and the other way round; the pointer names the version promoted last."""
    meta, registry = _champion_meta(spark, sf), shared_dir(spark, "registry")
    base, naive, hist = day_backtest_base(spark, sf), bt.SeasonalNaive(DAY_CFG.grain), bt.HistoricalMean()
    for champion, challenger, version in ((naive, hist, "historical-mean-v1"), (hist, naive, "seasonal-naive-v2")):
        decision = pm.promote_if_better(base, champion, challenger, meta, DAY_CFG.grain, 0.02)
        won = decision.first()["promoted"]
        pm.record_decision(decision, registry, version if won else None, f"models/{version}" if won else None)
    return pm.current_model(spark, registry)


@register("promotion_run")
def q_promotion_run(spark, sf):
    """The saved artifact is challenged by one fitted on everything before the
    newest full month that it has not seen; the winner is archived and recorded."""
    registry = shared_dir(spark, "promotion")
    pm.run_promotion(day_features(spark, sf), _artifact(spark, sf), DAY_CFG, shared_dir(spark, "models"), registry, "v2", kind="poisson_trees")
    rows = [(n, d["status"], d["promoted"], d["eval_month"], d["mae_candidate"], d["mae_current"], d["new_version"]) for n, d in pm.decisions(spark, registry)]
    return spark.createDataFrame(rows, "number int, status string, promoted boolean, eval_month string, mae_candidate double, mae_current double, new_version string")


# ---------------------------------------------------------------- sources, sinks and streaming
from ..sources import archives  # noqa: E402
from ..sources import trips as src_trips  # noqa: E402
from ..sources import weather as src_weather  # noqa: E402
from ..streaming import hourly as stream_hourly  # noqa: E402
from ..schemas import TRIP_COLUMNS  # noqa: E402


def _trip_strings(t):
    """Trips as the raw files have them: fractional seconds, 'NULL' tokens."""
    out = []
    for c in TRIP_COLUMNS:
        v = F.col(c)
        if c in ("started_at", "ended_at"):
            v = F.date_format(v, "yyyy-MM-dd HH:mm:ss.SSSSSS")
        if dict(t.dtypes)[c] != "double":  # doubles are written by the CSV writer itself
            v = F.coalesce(v.cast("string"), F.lit("NULL"))
        out.append(v.alias(c))
    return out


@register("trip_csv_roundtrip")
def q_csv_roundtrip(spark, sf):
    """Trips land as CSV with fractional seconds and 'NULL' tokens; the strict
    typed reader restores the contract (seconds truncated)."""
    t = adapters.events_trips(spark, sf)
    landing = shared_dir(spark, "landing-csv")
    (t.select(*_trip_strings(t), F.date_format("started_at", "yyyy-MM").alias("month"))
     .write.option("header", True).partitionBy("month").csv(landing))
    return src_trips.read_trip_csv(spark, landing)


@register("trip_zip_roundtrip")
def q_zip_roundtrip(spark, sf):
    """The same through zip archives: several members an archive, each read by a task of its own."""
    t = adapters.events_trips(spark, sf)
    landing = shared_dir(spark, "landing-zip")
    archives.write_archives(t.repartition(4, "ride_id").select(*[c.cast("string") for c in _trip_strings(t)]).toDF(*TRIP_COLUMNS), landing, "202401-tripdata", 2_000)
    return src_trips.read_trip_zips(spark, landing)


def _land_trips_csv(t, landing: str, mode: str = "overwrite") -> None:
    t.select(*_trip_strings(t)).write.mode(mode).option("header", True).csv(landing)


@register("stream_ingest_trips")
def q_stream_ingest(spark, sf):
    """Trips land as CSV files in two drops; the availableNow file stream
    ingests each file exactly once into the per-month Parquet table."""
    from ..streaming.ingest import ingest_trip_files
    t = adapters.events_trips(spark, sf)
    landing, out, ckpt = shared_dir(spark, "ingest-landing"), shared_dir(spark, "ingest-out"), shared_dir(spark, "ingest-ckpt")
    first, last = t.agg(F.min("started_at"), F.max("started_at")).first()
    mid = first + (last - first) / 2
    _land_trips_csv(t.where(F.col("started_at") < F.lit(mid)), landing, "append")
    ingest_trip_files(spark, landing, out, ckpt)
    _land_trips_csv(t.where(F.col("started_at") >= F.lit(mid)), landing, "append")
    ingest_trip_files(spark, landing, out, ckpt)
    return spark.read.parquet(out).select(*TRIP_COLUMNS)


@register("incremental_months")
def q_incremental(spark, sf):
    """Months offered by the landed file names (YYYYMM-...zip) within the
    configured range, minus months already in the per-month store."""
    trips = adapters.orders_trips(spark, sf)
    names = trips.select(F.concat(F.date_format("started_at", "yyyyMM"), F.lit("-tripdata.zip")).alias("path")).distinct()
    available = src_trips.months_in_range(names, "1996-01", "2000-12")
    store = shared_dir(spark, "by-month")
    src_trips.write_by_month(trips.where(F.col("started_at") < F.lit(_dt.datetime(1998, 1, 1))), store)
    return src_trips.incremental_months(available, src_trips.stored_months(spark, store))


@register("payload_to_rows")
def q_payload(spark, sf):
    """Daily payloads (objects of parallel hourly arrays) are written as JSON
    and reshaped back to the covariate contract."""
    cov = hour_covariates(spark, sf)
    fields = ["temperature_2m", "precipitation", "snowfall", "wind_speed_10m", "relative_humidity_2m"]
    rows = F.array_sort(F.collect_list(F.struct(F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm").alias("time"),
                                                *[F.col(c) for c in fields])))
    daily = (cov.groupBy(F.to_date("timestamp").alias("d")).agg(rows.alias("r"))
             .select(F.struct(F.col("r.time").alias("time"), *[F.col(f"r.{c}").alias(c) for c in fields]).alias("hourly")))
    path = shared_dir(spark, "payloads")
    daily.write.json(path)
    return round6(src_weather.read_payloads(spark, path, multiline=False))


@register("stream_hour_counts")
def q_stream(spark, sf):
    """Clean trips land in two batches; the streaming hour count (watermark,
    update mode, idempotent upsert sink) is run after each landing."""
    clean = hour_clean(spark, sf).select("station_id", "started_at")
    landing, sink, ckpt = shared_dir(spark, "landing"), shared_dir(spark, "counts"), shared_dir(spark, "stream-ckpt")
    mid = clean.agg(F.min("started_at"), F.max("started_at")).first()
    split = mid[0] + (mid[1] - mid[0]) / 2
    for part in (clean.where(F.col("started_at") < F.lit(split)), clean.where(F.col("started_at") >= F.lit(split))):
        part.write.mode("append").parquet(landing)
        stream_hourly.run_hourly_counts(spark, landing, clean.schema, sink, ckpt)
    return stream_hourly.read_counts(spark, sink)


@register("busiest_series_range")
def q_busiest(spark, sf):
    """Busiest key (top-1 by volume, ties by key) and its bucket range in the grid."""
    top = grid.select_scope(day_clean(spark, sf), 1, DAY_CFG.scope_lookback_days)
    g = day_grid(spark, sf).join(F.broadcast(top.select("station_id")), "station_id", "left_semi")
    return g.groupBy("station_id").agg(F.min("hour").alias("first_hour"), F.max("hour").alias("last_hour"),
                                      F.sum("trips").cast("bigint").alias("total_trips"),
                                      F.count(F.lit(1)).alias("buckets"))


@register("recent_partitions")
def q_recent_parts(spark, sf):
    return fc.recent_partitions(_store(spark, sf), 5)


@register("artifact_backtest")
def q_artifact_bt(spark, sf):
    """The saved artifact, frozen, against seasonal naive on the windows after its cutoff."""
    art = _artifact(spark, sf)
    f = day_features(spark, sf)
    cut = _dt.datetime.fromisoformat(art.metadata["train_through"])
    after = f.where(F.col("hour") > F.lit(cut))
    return bt.run_backtest(after, [ml.ArtifactPredictor(art), bt.SeasonalNaive(DAY_CFG.grain)], DAY_CFG.n_windows, DAY_CFG.grain)


@register("grid_trip_total")
def q_grid_total(spark, sf):
    """Conservation: trips in the hourly grid equal the clean in-scope rows."""
    g = hour_grid(spark, sf).agg(F.sum("trips").cast("bigint").alias("grid_trips"))
    c = hour_clean(spark, sf).join(F.broadcast(hour_scope(spark, sf).select("station_id")), "station_id", "left_semi")
    n = c.agg(F.count(F.lit(1))).scalar()
    return g.withColumn("clean_in_scope", n).withColumn("conserved", F.col("grid_trips") == F.col("clean_in_scope"))


@register("served_error_by_hour")
def q_served_by_hour(spark, sf):
    """Served-forecast error by hour of day (hourly store vs. actuals)."""
    detail = fc.prediction_actual_table(_store(spark, sf), hour_grid(spark, sf))
    return round6(detail.groupBy(F.hour("hour").cast("int").alias("hour_of_day")).agg(
        F.avg("absolute_error").alias("mae"), F.avg("actual").alias("avg_trips"),
        F.avg(F.col("prediction") - F.col("actual")).alias("mean_bias"), F.count(F.lit(1)).alias("n")))


@register("event_calendar_csv")
def q_event_calendar_csv(spark, sf):
    """The named-period calendar as a file: written as CSV, read with its own
    schema, expanded to days, and counted per name over the orders' years."""
    path = shared_dir(spark, "calendar")
    adapters.event_calendar(spark).write.csv(path, header=True)
    days = dimensions.read_event_calendar(spark, path)
    dates = adapters.table(spark, sf, "orders").select(F.to_date("o_orderdate").alias("d"))
    each = days.select("event_name", F.explode(F.sequence("start_date", "end_date")).alias("d"))
    hit = dates.join(each, "d")
    return hit.groupBy("event_name").agg(F.count(F.lit(1)).alias("orders"))


@register("id_mapping_csv")
def q_id_mapping_csv(spark, sf):
    path = shared_dir(spark, "mapping")
    adapters.supplier_mapping(spark, sf).write.csv(path, header=True)
    return dimensions.read_id_mapping(spark, path)
