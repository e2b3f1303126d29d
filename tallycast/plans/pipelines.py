"""Shared data products over the test tables (hour grain on events, day grain
on orders x lineitem).

Products that many queries reuse (scope, counts, grid, features) are built
once per session and data folder and written as Parquet to the shared folder
(``spark.checkpoint.dir``): later plans start from a plain scan instead of
re-deriving the grid inside every scalar subquery, and a lost executor loses
nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..config import DAILY, DEFAULT, Config
from ..functions.exprs import materialize
from ..operators import cleaning, features, grid
from . import adapters

HOUR_CFG = DEFAULT
DAY_CFG = DAILY

_PRODUCTS: dict[tuple, DataFrame] = {}


def product(spark: SparkSession, sf: str, name: str, build, mode: str = "table") -> DataFrame:
    key = (spark.sparkContext.applicationId, sf, name)
    if key not in _PRODUCTS:
        _PRODUCTS[key] = build() if mode == "as is" else materialize(build(), mode)
    return _PRODUCTS[key]


def clear_products() -> None:
    _PRODUCTS.clear()


def hour_clean(spark: SparkSession, sf: str, guard: bool = True) -> DataFrame:
    return cleaning.clean_trips(adapters.events_trips(spark, sf), HOUR_CFG,
                                adapters.supplier_mapping(spark, sf), guard=guard)


def day_clean(spark: SparkSession, sf: str, scope: DataFrame | None = None) -> DataFrame:
    """With ``scope`` the rows of its stations only. Raw ids are the canonical
    ones here, so line items of other stations need not meet their orders."""
    return cleaning.clean_trips(adapters.orders_trips(spark, sf, scope), DAY_CFG, None)


def _series(spark, sf, tag: str, clean_fn, cfg: Config, trim: bool) -> DataFrame:
    # the narrow (key, start) projection of the clean rows is read by scope,
    # counts and lifetime trim: persist it once instead of re-running the
    # cleaning joins three times
    narrow = product(spark, sf, f"{tag}_clean_narrow",
                     lambda: clean_fn(spark, sf).select("station_id", "started_at"))
    scope = product(spark, sf, f"{tag}_scope",
                    lambda: grid.select_scope(narrow, cfg.top_n, cfg.scope_lookback_days))
    counts = product(spark, sf, f"{tag}_counts", lambda: grid.series_counts(narrow, scope, cfg.grain))
    if not trim:
        return product(spark, sf, f"{tag}_full", lambda: _dense(materialize(grid.full_grid(counts, scope, cfg.grain), "table")), "as is")
    return product(spark, sf, f"{tag}_grid",
                   lambda: grid.lifetime_grid(counts, narrow, scope, cfg.grain, phase=cfg.grain))


def _dense(full: DataFrame) -> DataFrame:
    grid.assert_grid_complete(full)
    return full


def hour_scope(spark, sf):
    _series(spark, sf, "hour", hour_clean, HOUR_CFG, trim=False)
    return product(spark, sf, "hour_scope", None)


def hour_grid_phased(spark: SparkSession, sf: str) -> DataFrame:
    """Trimmed hourly grid + ``hour_of_day``, partitioned by (key, hour_of_day)."""
    return _series(spark, sf, "hour", hour_clean, HOUR_CFG, True)


def day_grid_phased(spark: SparkSession, sf: str) -> DataFrame:
    """Trimmed daily grid + ``day_of_week``, partitioned by (key, day_of_week)."""
    return _series(spark, sf, "day", day_clean, DAY_CFG, True)


def hour_grid(spark: SparkSession, sf: str, trim: bool = True) -> DataFrame:
    """Grid contract (station_id, hour, trips)."""
    g = _series(spark, sf, "hour", hour_clean, HOUR_CFG, trim)
    return g.select("station_id", "hour", "trips")


def day_grid(spark: SparkSession, sf: str, trim: bool = True) -> DataFrame:
    g = _series(spark, sf, "day", day_clean, DAY_CFG, trim)
    return g.select("station_id", "hour", "trips")


def hour_master(spark, sf):
    return product(spark, sf, "hour_master", lambda: grid.station_master(hour_clean(spark, sf), HOUR_CFG))


def day_scope(spark, sf):
    _series(spark, sf, "day", day_clean, DAY_CFG, trim=True)
    return product(spark, sf, "day_scope", None)


def day_master(spark, sf):
    """Master of the stations in scope, the only ones that the day grid's rows
    meet. Their clean rows are written once: the master reads them three times,
    each of which would join all orders and line items again."""
    scope = day_scope(spark, sf)
    rows = product(spark, sf, "day_clean_scope", lambda: day_clean(spark, sf, scope).select(
        "station_id", "started_at", "start_station_name", "start_lat", "start_lng"))
    return product(spark, sf, "day_master", lambda: grid.station_master(rows, DAY_CFG))


def hour_covariates(spark, sf):
    return product(spark, sf, "hour_cov", lambda: adapters.events_covariates(spark, sf))


def day_covariates(spark, sf):
    return product(spark, sf, "day_cov", lambda: adapters.orders_covariates(spark, sf))


def hour_features(spark: SparkSession, sf: str) -> DataFrame:
    return product(spark, sf, "hour_features", lambda: features.build_features(
        hour_grid_phased(spark, sf), hour_covariates(spark, sf), hour_master(spark, sf), HOUR_CFG))


def day_features(spark: SparkSession, sf: str) -> DataFrame:
    return product(spark, sf, "day_features", lambda: features.build_features(
        day_grid_phased(spark, sf), day_covariates(spark, sf), day_master(spark, sf), DAY_CFG))


def day_backtest_base(spark: SparkSession, sf: str) -> DataFrame:
    """Day-grain grid with calendar and lag features (backtest input)."""
    return product(spark, sf, "day_bt_base", lambda: features.add_lag_features(
        features.add_calendar_features(day_grid_phased(spark, sf)), DAY_CFG.grain))


def day_baselines():
    from ..operators.backtest import HistoricalMean, SeasonalNaive
    return [SeasonalNaive(DAY_CFG.grain), HistoricalMean()]


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder under the session's shared checkpoint location (never a
    machine-local temp folder) for tables a query writes and reads back."""
    import uuid

    from ..session import ensure_checkpoint_dir

    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/tallycast-{name}-{uuid.uuid4().hex[:10]}"


def hour_replay_days(spark: SparkSession, sf: str, n: int = 2):
    """The n days before the last day of the hourly grid (data-derived as_of dates)."""
    import datetime as dt

    from pyspark.sql import functions as F

    last = hour_grid(spark, sf).agg(F.max("hour")).first()[0]
    return [last.date() - dt.timedelta(days=i) for i in range(n, 0, -1)]


def hour_store(spark: SparkSession, sf: str) -> str:
    """Forecast store with seasonal-naive partitions for the replay days."""
    key = (spark.sparkContext.applicationId, sf, "hour_store_path")
    if key in _PRODUCTS:
        return _PRODUCTS[key]
    from ..operators import forecast as fc
    from ..operators.models import NaiveArtifact

    path = shared_dir(spark, "store")
    art = NaiveArtifact(HOUR_CFG.grain.naive_lag)
    fc.run_batch_predict_days(hour_replay_days(spark, sf), hour_grid(spark, sf), hour_covariates(spark, sf),
                              hour_master(spark, sf), HOUR_CFG, art, art.metadata, path)
    _PRODUCTS[key] = path
    return path
