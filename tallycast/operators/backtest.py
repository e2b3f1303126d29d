"""Rolling-origin backtest: predictors, evaluation windows, metrics, summary.

A predictor maps (features, windows) to rows ``(window, station_id, hour,
trips, prediction)`` for every evaluation row of every window. Baselines do
this for all windows in ONE plan; model predictors fit once per window
(a short driver loop over at most ``n_windows`` fits, each fit distributed).
Train for window ``w`` = rows of months before ``w``; eval = rows of ``w``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import Grain
from ..functions.calendar import last_bucket_of_month
from ..functions.exprs import bounded_broadcast, month_str

KEY = "station_id"


def with_month(df: DataFrame, ts: str = "hour") -> DataFrame:
    return df.withColumn("_month", month_str(ts))


def eval_months(df: DataFrame, n: int, grain: Grain, ts: str = "hour") -> DataFrame:
    """Last ``n`` calendar months present; the final month is dropped when its
    last bucket is missing (the first one is not checked). <= n rows."""
    last = df.agg(F.max(ts).alias("m"))
    last_hour = last.select("m").scalar()
    full = last.select(F.col("m") >= last_bucket_of_month(F.col("m"), grain.unit)).scalar()
    months = df.select(month_str(ts).alias("window")).distinct()
    months = months.where(~((F.col("window") == month_str(last_hour)) & ~full))
    return months.orderBy(F.desc("window")).limit(n)


def month_summary(df: DataFrame, ts: str = "hour") -> list[tuple[str, object]]:
    """(month, last bucket) per calendar month present, sorted. One small job;
    the list is bounded by the number of months in the data."""
    rows = df.groupBy(month_str(ts).alias("m")).agg(F.max(ts).alias("mx")).orderBy("m").collect()
    return [(r["m"], r["mx"]) for r in rows]


def window_table(df: DataFrame, n: int, grain: Grain, ts: str = "hour", only: str | None = None) -> DataFrame:
    """Eval windows (last ``n`` months, a trailing partial month dropped) with
    their training cutoff (= last bucket of the previous month present), as a
    literal table of at most ``n`` rows built from the month summary. Later
    plans reference this tiny local relation instead of re-running scalar
    subqueries over the features. Same rule as ``eval_months``."""
    months = month_summary(df, ts)
    spark = df.sparkSession
    if not months:
        return spark.createDataFrame([], "window string, cutoff timestamp_ntz")
    last_hour = months[-1][1]
    full = last_hour >= spark.range(1).select(
        last_bucket_of_month(F.lit(last_hour).cast("timestamp_ntz"), grain.unit)).first()[0]
    cutoffs = [(m, months[i - 1][1] if i else None) for i, (m, _) in enumerate(months)]
    if not full:
        cutoffs = cutoffs[:-1]
    keep = [c for c in cutoffs if c[0] == only] if only else cutoffs[-n:] if n > 0 else []
    return bounded_broadcast(spark.createDataFrame(keep, "window string, cutoff timestamp_ntz"))


def _first_window_start(windows: DataFrame):
    first = windows.agg(F.min("window")).first()[0]
    return F.lit(None).cast("timestamp_ntz") if first is None else F.to_timestamp_ntz(F.lit(first + "-01"))


def eval_rows(features: DataFrame, windows: DataFrame, ts: str = "hour") -> DataFrame:
    # the range predicate on the bucket prunes files/row groups before the semi join
    return (features.where(F.col(ts) >= _first_window_start(windows))
            .withColumn("window", month_str(ts))
            .join(bounded_broadcast(windows.select("window")), "window", "left_semi"))


class SeasonalNaive:
    """Same bucket one week earlier (leak-safe weekly lag), null -> 0."""

    name = "seasonal_naive"

    def __init__(self, grain: Grain):
        self.grain = grain

    def predict_all(self, features: DataFrame, windows: DataFrame) -> DataFrame:
        ev = eval_rows(features, windows)
        return ev.select("window", KEY, "hour", "trips",
                         F.coalesce(F.col(self.grain.naive_lag).cast("double"), F.lit(0.0)).alias("prediction"))


class HistoricalMean:
    """Mean of the last ``weeks`` weeks before the window by (key, weekday,
    hour of day), falling back to the key mean, then 0."""

    name = "historical_mean"

    def __init__(self, weeks: int = 8):
        self.weeks = weeks

    def recent_rows(self, features: DataFrame, windows: DataFrame) -> DataFrame:
        # the windows (a handful of rows) become an array: each row is copied to
        # those whose look-back holds it, however long that is and over gaps
        cut = [(r["window"], r["cutoff"]) for r in windows.select("window", "cutoff").collect() if r["cutoff"] is not None]
        if not cut:
            return features.limit(0).select(KEY, "hour", "trips", "day_of_week", "hour_of_day", F.lit("").alias("window"))
        back = F.expr(f"INTERVAL {7 * self.weeks} DAYS")
        spans = F.array(*[F.struct(F.lit(w).alias("window"), F.lit(c).cast("timestamp_ntz").alias("cutoff")) for w, c in cut])
        mine = F.filter(spans, lambda s: (F.col("hour") <= s["cutoff"]) & (F.col("hour") > s["cutoff"] - back))
        earliest = F.lit(min(c for _, c in cut)).cast("timestamp_ntz") - back
        return (features.where(F.col("hour") > earliest)
                .select(KEY, "hour", "trips", "day_of_week", "hour_of_day", F.explode(mine).alias("s"))
                .select(KEY, "hour", "trips", "day_of_week", "hour_of_day", "s.window"))

    def predict_all(self, features: DataFrame, windows: DataFrame) -> DataFrame:
        recent = self.recent_rows(features, windows)
        keys = ["window", KEY, "day_of_week", "hour_of_day"]
        profile = recent.groupBy(*keys).agg(F.avg("trips").alias("profile_mean"))
        station = recent.groupBy("window", KEY).agg(F.avg("trips").alias("station_mean"))
        ev = eval_rows(features, windows)
        return (ev.join(profile, keys, "left").join(station, ["window", KEY], "left")
                .select("window", KEY, "hour", "trips",
                        F.coalesce("profile_mean", "station_mean", F.lit(0.0)).alias("prediction")))


def all_predictions(features: DataFrame, predictors: list, windows: DataFrame) -> DataFrame:
    out = None
    for p in predictors:
        d = p.predict_all(features, windows).withColumn("predictor", F.lit(p.name))
        out = d if out is None else out.unionByName(d)
    return out


def metrics(preds: DataFrame, by: list[str]) -> DataFrame:
    """MAE, RMSE and n; pairs with a null side are skipped by the averages."""
    err = F.col("trips") - F.col("prediction")
    return preds.groupBy(*by).agg(F.avg(F.abs(err)).alias("mae"),
                                  F.sqrt(F.avg(F.pow(err, 2))).alias("rmse"),
                                  F.count(F.lit(1)).alias("n"))


def run_backtest(features: DataFrame, predictors: list, n_windows: int, grain: Grain) -> DataFrame:
    """One row per (predictor, window): mae, rmse, n."""
    windows = window_table(features, n_windows, grain)
    return metrics(all_predictions(features, predictors, windows), ["predictor", "window"])


def summarize(results: DataFrame, digits: int = 3, naive: str = "seasonal_naive") -> DataFrame:
    """MASE = mae / naive mae of the same window, then means (std: sample)."""
    nv = results.where(F.col("predictor") == naive).select("window", F.col("mae").alias("naive_mae"))
    m = results.join(F.broadcast(nv), "window", "left").withColumn(
        "mase", F.try_divide(F.col("mae"), F.col("naive_mae")))
    return (m.groupBy("predictor").agg(
        F.round(F.avg("mae"), digits).alias("mae_mean"),
        F.round(F.stddev_samp("mae"), digits).alias("mae_std"),
        F.round(F.avg("rmse"), digits).alias("rmse_mean"),
        F.round(F.avg("mase"), digits).alias("mase_mean")).orderBy("mae_mean"))


def prediction_table(features: DataFrame, predictors: list, month: str | None, grain: Grain,
                     n_windows: int = 1) -> DataFrame:
    """Wide table for one window: key, hour, trips, ``pred_<name>`` per predictor
    (a single pivot instead of one join per predictor). ``month=None`` takes
    the latest evaluation month."""
    windows = window_table(features, n_windows, grain)
    if month is not None:
        windows = windows.where(F.col("window") == month)
    else:
        windows = bounded_broadcast(windows.orderBy(F.desc("window")).limit(1))
    preds = all_predictions(features, predictors, windows)
    names = [p.name for p in predictors]
    return (preds.groupBy(KEY, "hour", "trips").pivot("predictor", names).agg(F.first("prediction"))
            .select(KEY, "hour", "trips", *[F.col(n).alias(f"pred_{n}") for n in names]))
