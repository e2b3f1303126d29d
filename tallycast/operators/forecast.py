"""Serving: leak-safe inference features, the versioned forecast store,
replay, evaluation against actuals and store lookups.

The store keeps every write in a folder of its own, ``data/attempt=<id>/as_of=<day>``;
a day's forecast becomes visible by a numbered commit record in
``commits/as_of=<day>``, created only if absent, and readers follow the newest
record of each day. A writer that dies leaves files that no record names, and of
two writers of the same day one learns that it came second.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import Config, Grain
from ..functions.exprs import materialize
from ..sources.commits import commit, records, records_by_folder
from . import features as feat

KEY = "station_id"
STORE_COLUMNS = ["as_of", KEY, "hour", "prediction", "model_version", "created_at"]


def last_known_bucket(as_of: dt.date, grain: Grain) -> dt.datetime:
    base = dt.datetime(as_of.year, as_of.month, as_of.day)
    return base + dt.timedelta(hours=23) if grain.unit == "hour" else base


def _step(grain: Grain) -> dt.timedelta:
    return dt.timedelta(hours=1) if grain.unit == "hour" else dt.timedelta(days=1)


def history_coverage(history: DataFrame, as_of: dt.date, grain: Grain) -> DataFrame:
    """Per key (all keys seen up to ``as_of``): rows, distinct buckets, first and
    last bucket of the recent window, and whether it is complete."""
    last = last_known_bucket(as_of, grain)
    needed = grain.needed_history
    start = last + _step(grain) * (1 - needed)
    hist = history.where(F.col("hour") <= F.lit(last))
    keys = hist.select(KEY).distinct()
    recent = hist.where(F.col("hour") >= F.lit(start))
    cov = recent.groupBy(KEY).agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct("hour").alias("n_hours"),
                                  F.min("hour").alias("first_hour"), F.max("hour").alias("last_hour"))
    out = keys.join(cov, KEY, "left")
    bad = ((F.coalesce("n_rows", F.lit(0)) != needed) | (F.coalesce("n_hours", F.lit(0)) != needed)
           | ~F.col("first_hour").eqNullSafe(F.lit(start)) | ~F.col("last_hour").eqNullSafe(F.lit(last)))
    return out.withColumn("complete", ~bad)


def history_coverage_days(history: DataFrame, days: list[dt.date], grain: Grain) -> DataFrame:
    """``history_coverage`` of several ``as_of`` days in one plan (adds ``as_of``):
    rows are copied to the days whose recent window holds them."""
    needed, step = grain.needed_history, _step(grain)
    spans = [(d, last_known_bucket(d, grain)) for d in days]
    every = F.array(*[F.struct(F.lit(d).alias("as_of"), F.lit(last - step * (needed - 1)).alias("start"), F.lit(last).alias("last")) for d, last in spans])
    keys = (history.groupBy(KEY).agg(F.min("hour").alias("since"))
            .select(KEY, F.explode(F.filter(every, lambda s: F.col("since") <= s["last"])).alias("s")).select(KEY, "s.*"))
    held = F.filter(every, lambda s: (F.col("hour") >= s["start"]) & (F.col("hour") <= s["last"]))
    recent = (history.where(F.col("hour").between(F.lit(min(last for _, last in spans) - step * (needed - 1)), F.lit(max(last for _, last in spans))))
              .select(KEY, "hour", F.explode(held).alias("s")).groupBy(KEY, "s.as_of")
              .agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct("hour").alias("n_hours"), F.min("hour").alias("first_hour"), F.max("hour").alias("last_hour")))
    whole = ((F.col("n_rows") == needed) & (F.col("n_hours") == needed) & (F.col("first_hour") == F.col("start")) & (F.col("last_hour") == F.col("last")))
    return keys.join(recent, [KEY, "as_of"], "left").withColumn("complete", F.coalesce(whole, F.lit(False)))


def build_inference_features(history: DataFrame, covariates: DataFrame | None, master: DataFrame | None,
                             as_of: dt.date, cfg: Config, horizon: int | None = None,
                             check: bool = True) -> DataFrame:
    """Future rows for the ``horizon`` buckets after ``as_of`` for every key with
    complete recent history, built with the same feature functions as training."""
    grain = cfg.grain
    horizon = horizon or grain.horizon
    feat.assert_no_leak(grain.lags, horizon)
    last = last_known_bucket(as_of, grain)
    needed = grain.needed_history
    start = last + _step(grain) * (1 - needed)
    hist = history.where(F.col("hour") <= F.lit(last)).select(KEY, "hour", "trips")
    if check:
        cov = history_coverage(history, as_of, grain)
        stats = cov.agg(F.count(F.lit(1)).alias("keys"), F.count_if(~F.col("complete")).alias("incomplete")).first()
        if stats["keys"] == 0:
            raise ValueError("history is empty through the requested as_of date")
        if stats["incomplete"]:
            some = [r[KEY] for r in cov.where(~F.col("complete")).orderBy(KEY).limit(5).collect()]
            raise ValueError(f"{stats['incomplete']} of {stats['keys']} keys lack buckets between {start} and {last} "
                             f"({needed} needed each), for instance {some}; history is incomplete")
    recent = hist.where(F.col("hour") >= F.lit(start))
    first_future, last_future = last + _step(grain), last + _step(grain) * horizon
    future = (hist.select(KEY).distinct()
              .select(KEY, F.explode(F.sequence(F.lit(first_future), F.lit(last_future), F.expr(grain.interval))).alias("hour"),
                      F.lit(None).cast("int").alias("trips")))
    frame = feat.add_calendar_features(recent.unionByName(future))
    if covariates is not None:
        frame = feat.add_covariates(frame, covariates, cfg, check=check)
    if master is not None:
        frame = feat.add_station_features(frame, master, cfg if check else None)
    frame = feat.add_lag_features(frame, grain)
    return frame.where(F.col("hour") > F.lit(last))


def replay_inference_features(history: DataFrame, as_of_days: list[dt.date], cfg: Config,
                              covariates: DataFrame | None = None, horizon: int | None = None,
                              master: DataFrame | None = None) -> DataFrame:
    """All replay days in ONE plan: target-derived features of a future bucket
    only use buckets at least one horizon earlier, so computing lags once and
    keeping each day's horizon is identical to building each day separately (the
    leakage guard makes this exact). History older than the first day's look-back
    is not read. Adds ``as_of``."""
    grain = cfg.grain
    horizon = horizon or grain.horizon
    feat.assert_no_leak(grain.lags, horizon)
    spark = history.sparkSession
    days = spark.createDataFrame([(d,) for d in as_of_days], "as_of date")
    shift = "HOUR" if grain.unit == "hour" else "DAY"
    last = F.to_timestamp_ntz(F.col("as_of")) + (F.expr("INTERVAL 23 HOURS") if grain.unit == "hour" else F.expr("INTERVAL 0 DAYS"))
    targets = days.select("as_of", F.explode(F.sequence(F.timestamp_add(shift, F.lit(1), last),
                                                        F.timestamp_add(shift, F.lit(horizon), last),
                                                        F.expr(grain.interval))).alias("hour"))
    since = min(last_known_bucket(d, grain) for d in as_of_days) - _step(grain) * (grain.needed_history - 1)
    known = history.where(F.col("hour") >= F.lit(since)).select(KEY, "hour", "trips")
    # buckets after the history's end (at most one horizon per day) have no rows yet
    end, step = known.agg(F.max("hour")).first()[0], _step(grain)
    ahead = sorted({h for d in as_of_days for k in range(1, horizon + 1) if end is not None and (h := last_known_bucket(d, grain) + step * k) > end})
    future = history.select(KEY).distinct().select(KEY, F.explode(F.array(*[F.lit(h) for h in ahead]).cast("array<timestamp_ntz>")).alias("hour"), F.lit(None).cast("int").alias("trips"))
    frame = feat.add_lag_features(feat.add_calendar_features(known.unionByName(future)), grain)
    if covariates is not None:
        frame = feat.add_covariates(frame, covariates, cfg, check=False)
    if master is not None:
        frame = feat.add_station_features(frame, master)
    # as many rows as days times horizon
    return frame.join(F.broadcast(targets), "hour")


def _commits(path: str, as_of: dt.date) -> str:
    return f"{path}/commits/as_of={as_of.isoformat()}"


def newest_commits(spark: SparkSession, path: str, days: list[dt.date] | None = None) -> dict[dt.date, tuple[int, dict]]:
    """day -> (number, record) of its newest commit, in one read."""
    found = {dt.date.fromisoformat(k.split("=", 1)[1]): v[-1] for k, v in records_by_folder(spark, f"{path}/commits/as_of=*").items()}
    return {d: found[d] for d in sorted(found) if days is None or d in days}


def newest_commit(spark: SparkSession, path: str, as_of: dt.date) -> tuple[int, dict | None]:
    """(number, record) of the newest commit of a day; (0, None) without one."""
    found = records(spark, _commits(path, as_of))
    return found[-1] if found else (0, None)


def read_store(spark: SparkSession, path: str, days: list[dt.date] | None = None) -> DataFrame:
    """The committed forecasts of all days, or of those given (``as_of`` typed
    DATE); error when there are none. Files of writers that never committed,
    and those of replaced forecasts, are not read."""
    found = newest_commits(spark, path, days)
    if not found:
        raise ValueError(f"no forecast partitions found in {path}")
    folders = [f"{path}/data/attempt={record['attempt']}/as_of={d.isoformat()}" for d, (_, record) in found.items()]
    df = spark.read.option("basePath", f"{path}/data").parquet(*folders)
    return df.withColumn("as_of", F.col("as_of").cast("date")).select(*STORE_COLUMNS)


def stage_forecasts(predictions: DataFrame, path: str) -> str:
    """Writes forecasts (``STORE_COLUMNS``) of any number of days where no reader
    looks yet; returns the attempt's id."""
    attempt = uuid.uuid4().hex
    predictions.select(*STORE_COLUMNS).write.partitionBy("as_of").parquet(f"{path}/data/attempt={attempt}")
    return attempt


def commit_forecast(spark: SparkSession, path: str, as_of: dt.date, attempt: str, model_version: str, after: int, force: bool = False) -> str:
    """Makes a staged day visible as commit ``after`` + 1. Where another writer
    was faster: ``skipped`` if it wrote the same version, an error if another,
    with ``force`` the next number."""
    while True:
        if commit(spark, _commits(path, as_of), after + 1, {"attempt": attempt, "model_version": model_version}):
            return "written"
        after, other = newest_commit(spark, path, as_of)
        if force:
            continue
        if other["model_version"] == model_version:
            return "skipped"
        raise ValueError(f"partition as_of={as_of} belongs to model version(s) {[other['model_version']]}, not {model_version}")


def _may_write(newest: tuple[int, dict | None], as_of: dt.date, model_version: str, force: bool) -> int | None:
    """Number of the newest commit of a day that may be written; None where it holds this version."""
    number, record = newest
    if record is not None and not force:
        if record["model_version"] == model_version:
            return None
        raise ValueError(f"partition as_of={as_of} belongs to model version(s) {[record['model_version']]}, not {model_version}")
    return number


def write_partition(predictions: DataFrame, path: str, as_of: dt.date, model_version: str,
                    force: bool = False, created_at: str | None = None) -> str:
    """Idempotent daily partition: skipped when it already holds exactly this
    model version, refused to another version unless ``force``; otherwise staged
    and then committed."""
    spark = predictions.sparkSession
    number = _may_write(newest_commit(spark, path, as_of), as_of, model_version, force)
    if number is None:
        return "skipped"
    created_at = created_at or dt.datetime.now(dt.timezone.utc).isoformat()
    out = predictions.select(F.lit(as_of).alias("as_of"), KEY, "hour", F.col("prediction").cast("double"),
                             F.lit(model_version).alias("model_version"), F.lit(created_at).alias("created_at"))
    return commit_forecast(spark, path, as_of, stage_forecasts(out, path), model_version, number, force)


def run_batch_predict(as_of: dt.date, history: DataFrame, covariates: DataFrame | None, master: DataFrame | None,
                      cfg: Config, model, metadata: dict, store_path: str, force: bool = False) -> str:
    """Artifact cutoff must not be after ``as_of``; features -> predictions -> partition."""
    feat.assert_no_leak(cfg.grain.lags, cfg.grain.horizon, dt.date.fromisoformat(str(metadata["train_through"])[:10]), as_of)
    if _may_write(newest_commit(history.sparkSession, store_path, as_of), as_of, metadata["model_version"], force) is None:
        return "skipped"
    frame = build_inference_features(history, covariates, master, as_of, cfg)
    preds = model.score(frame)
    return write_partition(preds, store_path, as_of, metadata["model_version"], force)


def run_batch_predict_days(days: list[dt.date], history: DataFrame, covariates: DataFrame | None,
                           master: DataFrame | None, cfg: Config, model, metadata: dict, store_path: str,
                           force: bool = False) -> dict:
    """Several ``as_of`` partitions with the same checks as ``run_batch_predict``
    but one coverage job and ONE write job: all pending days are staged
    together and then committed one by one. Returns day -> status."""
    feat.assert_no_leak(cfg.grain.lags, cfg.grain.horizon, dt.date.fromisoformat(str(metadata["train_through"])[:10]), min(days))
    version = metadata["model_version"]
    spark = history.sparkSession
    status, pending = {}, {}
    committed = newest_commits(spark, store_path, days)
    for d in days:
        number = _may_write(committed.get(d, (0, None)), d, version, force)
        if number is None:
            status[d] = "skipped"
        else:
            pending[d] = number
    if not pending:
        return status
    cov = history_coverage_days(history, list(pending), cfg.grain)
    bad = cov.where(~F.col("complete")).groupBy("as_of").agg(F.count(F.lit(1)).alias("n")).collect()
    if bad:
        raise ValueError(f"recent history is incomplete for as_of {sorted(r['as_of'] for r in bad)}")
    frames = replay_inference_features(history, list(pending), cfg, covariates, master=master)
    if covariates is not None:
        first = [c for c in covariates.columns if c != "timestamp"][0]
        frames = materialize(frames, "table")
        rate = frames.agg(F.avg(F.col(first).isNotNull().cast("double"))).first()[0]
        if rate is None or rate < cfg.min_covariate_match:
            raise ValueError(f"covariate join matched only {0 if rate is None else rate:.1%} of future rows")
    frames = model.score(frames).select("as_of", KEY, "hour", F.col("prediction").cast("double"))
    created_at = dt.datetime.now(dt.timezone.utc).isoformat()
    out = frames.select("as_of", KEY, "hour", "prediction", F.lit(version).alias("model_version"),
                        F.lit(created_at).alias("created_at"))
    attempt = stage_forecasts(out, store_path)
    return status | {d: commit_forecast(spark, store_path, d, attempt, version, number, force) for d, number in pending.items()}


def prediction_actual_table(store: DataFrame, actuals: DataFrame) -> DataFrame:
    """Forecasts joined to actual counts (inner on key and bucket) + absolute error."""
    a = actuals.select(KEY, "hour", F.col("trips").alias("actual"))
    return store.join(a, [KEY, "hour"], "inner").withColumn(
        "absolute_error", F.abs(F.col("prediction") - F.col("actual")))


def unmatched_forecasts(store: DataFrame, actuals: DataFrame) -> DataFrame:
    return store.join(actuals.select(KEY, "hour"), [KEY, "hour"], "left_anti")


def evaluate_predictions(detail: DataFrame) -> DataFrame:
    """Daily MAE and n by (as_of, target_date); an error when no forecast has an actual."""
    if detail.isEmpty():
        raise ValueError("no forecast of the store has an actual count yet")
    return (detail.groupBy("as_of", F.to_date("hour").alias("target_date"))
            .agg(F.avg("absolute_error").alias("mae"), F.count(F.lit(1)).alias("n")))


def store_health(store: DataFrame) -> DataFrame:
    newest = store.agg(F.max("as_of")).scalar()
    ver = store.where(F.col("as_of") == newest).agg(F.min("model_version")).scalar()
    return store.agg(F.count_distinct("as_of").alias("partitions"), F.max("as_of").alias("newest_as_of"),
                     F.count(F.lit(1)).alias("rows")).withColumn("newest_model_version", ver)


def forecast_lookup(store: DataFrame, key: str, as_of: dt.date | None = None, digits: int = 2) -> DataFrame:
    """One key's forecast from the newest (or the given) partition, rounded; an
    error when there is none."""
    s = store
    if as_of is None:
        s = s.where(F.col("as_of") == store.agg(F.max("as_of")).scalar())
    else:
        s = s.where(F.col("as_of") == F.lit(as_of))
    s = s.where(F.col(KEY) == key)
    if s.isEmpty():
        raise ValueError(f"no forecast of {key!r} for {as_of or 'the newest day'}")
    return (s.select("as_of", KEY, "hour", F.round("prediction", digits).alias("prediction"),
                                              "model_version").orderBy("hour"))


def newest_scope(store: DataFrame, keys: DataFrame) -> DataFrame:
    """Keys present in the newest partition (semi join; the newest as_of is a scalar)."""
    newest = store.agg(F.max("as_of")).scalar()
    present = store.where(F.col("as_of") == newest).select(KEY)
    return keys.join(present, KEY, "left_semi")


def recent_partitions(store: DataFrame, n: int = 5) -> DataFrame:
    return store.select("as_of").distinct().orderBy(F.desc("as_of")).limit(n)


def replay_summary(daily: DataFrame, reference_mae: float) -> DataFrame:
    """One row: mean of the daily MAEs of a replay and its difference to a reference (negative: better)."""
    g = daily.agg(F.avg("mae").alias("mean_mae"), F.count(F.lit(1)).alias("days"), F.sum("n").alias("n"))
    return g.select("days", "n", "mean_mae", F.lit(float(reference_mae)).alias("reference_mae"), (F.col("mean_mae") - F.lit(float(reference_mae))).alias("delta"))
