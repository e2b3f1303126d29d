"""Feature engineering shared by training and serving.

Leakage rule: every target-derived feature uses values at least one horizon
before the bucket it describes. Lags are multiples of the seasonal cycle, so
lags and same-phase rolling means are computed with ONE window partitioned by
(key, phase) - e.g. (station, hour_of_day) - which is ``season`` times more
parallel than partitioning by key and needs the grid to be dense.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from ..config import Config, Grain
from ..functions.calendar import calendar_features, iso_dow
from ..functions.exprs import materialize
from ..sources.weather import assert_unique_time


def add_calendar_features(df: DataFrame, ts: str = "hour") -> DataFrame:
    return calendar_features(df, ts)


def covariate_match_rate(df: DataFrame, col: str = "temperature_2m") -> DataFrame:
    return df.agg(F.avg(F.col(col).isNotNull().cast("double")).alias("match_rate"),
                  F.count(F.lit(1)).alias("n_rows"))


def add_covariates(df: DataFrame, covariates: DataFrame, cfg: Config, check: bool = True,
                   ts_col: str = "timestamp") -> DataFrame:
    """Left join covariates on the bucket; fails when fewer than
    ``min_covariate_match`` of rows found a covariate row."""
    if check:
        assert_unique_time(covariates, ts_col)
    cov = covariates.withColumnRenamed(ts_col, "hour")
    out = df.join(cov, "hour", "left")
    if check:
        first = [c for c in cov.columns if c != "hour"][0]
        rate = covariate_match_rate(out, first).first()["match_rate"]
        if rate is None or rate < cfg.min_covariate_match:
            raise ValueError(f"covariate join matched only {0 if rate is None else rate:.1%} of rows; "
                             "time zone mismatch or missing coverage")
    return out


def add_station_features(df: DataFrame, master: DataFrame, cfg: Config | None = None,
                         key: str = "station_id") -> DataFrame:
    """Left join station coordinates; with ``cfg`` a key that the master lists
    twice is an error, as it would multiply rows."""
    m = master.select(key, "lat", "lng")
    if cfg is not None:
        twice = m.groupBy(key).agg(F.count(F.lit(1)).alias("n")).where("n > 1").limit(5).collect()
        if twice:
            raise ValueError(f"station master lists {[r[0] for r in twice]} more than once")
    return df.join(m, key, "left")


def phase(grain: Grain, ts: str = "hour"):
    return F.hour(ts).cast("int") if grain.unit == "hour" else iso_dow(F.col(ts))


def assert_no_leak(lags, horizon: int, train_through: dt.date | None = None, as_of: dt.date | None = None) -> None:
    """Every lag reaches back at least the horizon, and the model was not trained on days after ``as_of``."""
    if horizon > min(lags):
        raise ValueError(f"horizon {horizon} > min lag {min(lags)}: future targets would leak into lags")
    if train_through is not None and as_of is not None and train_through > as_of:
        raise ValueError(f"model was trained through {train_through}, after as_of={as_of}: replay would leak")


def add_lag_features(df: DataFrame, grain: Grain, key: str = "station_id", ts: str = "hour",
                     y: str = "trips") -> DataFrame:
    """lag_h = value h buckets earlier for the same key; roll_mean_k = mean of
    the same phase over the previous k cycles (nulls skipped; no history ->
    null). Requires a dense grid per key."""
    assert_no_leak(grain.lags, grain.horizon)
    bad = [h for h in grain.lags if h % grain.season]
    if bad:
        raise ValueError(f"lags {bad} are not multiples of the {grain.season}-bucket cycle")
    # a grid built with ``phase=grain`` already carries the phase column and is
    # hash-partitioned by (key, phase): the window then needs no exchange
    own = grain.phase_col not in df.columns
    ph = "_phase" if own else grain.phase_col
    out = df.withColumn(ph, phase(grain, ts)) if own else df
    w = Window.partitionBy(key, ph).orderBy(ts)
    cols = [F.lag(y, h // grain.season).over(w).alias(grain.lag_name(h)) for h in grain.lags]
    cols += [F.avg(y).over(w.rowsBetween(-k, -1)).alias(grain.roll_name(k)) for k in grain.rolling]
    out = out.select("*", *cols)
    return out.drop(ph) if own else out


def build_features(grid: DataFrame, covariates: DataFrame | None, master: DataFrame | None,
                   cfg: Config, check: bool = True, key: str = "station_id") -> DataFrame:
    """grid -> calendar -> covariates -> station coordinates -> lags.

    With ``check`` the result is written once to the shared folder (it is a
    reused data product) and the covariate coverage gate reads those rows, so
    it does not run the joins again; covariates must be unique per bucket."""
    df = add_calendar_features(grid)
    if covariates is not None:
        if check:
            assert_unique_time(covariates)
        df = df.join(covariates.withColumnRenamed("timestamp", "hour"), "hour", "left")
    if master is not None:
        df = add_station_features(df, master, cfg if check else None, key)
    out = add_lag_features(df, cfg.grain, key)
    if check and covariates is not None:
        out = materialize(out, "table")
        first = [c for c in covariates.columns if c != "timestamp"][0]
        rate = covariate_match_rate(out, first).first()["match_rate"]
        if rate is None or rate < cfg.min_covariate_match:
            raise ValueError(f"covariate join matched only {0 if rate is None else rate:.1%} of rows; "
                             "time zone mismatch or missing coverage")
    return out
