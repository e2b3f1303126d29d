"""Champion / challenger promotion on a month neither model has seen."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import Config, Grain
from ..functions.exprs import materialize
from ..sources.commits import commit, records
from ..sources.paths import has_data
from . import backtest as bt
from .models import Artifact, ArtifactPredictor, train_production


def unseen_full_month(features: DataFrame, train_through: dt.datetime, grain: Grain) -> DataFrame:
    """One row: the latest full month whose first day is strictly after the champion cutoff, null without one."""
    months = bt.eval_months(features, 10_000, grain)  # every month that data can have
    return (months.where(F.to_timestamp_ntz(F.concat("window", F.lit("-01"))) > F.lit(train_through))
            .agg(F.max("window").alias("eval_month")))


def latest_unseen_full_month(features: DataFrame, train_through: dt.datetime, grain: Grain) -> str | None:
    return unseen_full_month(features, train_through, grain).first()[0]


def promote_if_better(features: DataFrame, champion, challenger, champion_meta: dict, grain: Grain,
                      min_improvement: float = 0.02) -> DataFrame:
    """One decision row: waiting / kept / promoted. The challenger is promoted
    when its MAE <= champion MAE x (1 - min_improvement)."""
    if not 0 <= min_improvement < 1:
        raise ValueError("min_improvement must be in [0, 1)")
    spark = features.sparkSession
    through = dt.datetime.fromisoformat(str(champion_meta["train_through"]))
    month = latest_unseen_full_month(features, through, grain)
    schema = ("status string, promoted boolean, eval_month string, mae_candidate double, mae_current double, "
              "required_candidate_mae double, min_improvement double, current_version string")
    if month is None:
        return spark.createDataFrame([("waiting_for_unseen_month", False, None, None, None, None,
                                       float(min_improvement), champion_meta["model_version"])], schema)
    windows = bt.window_table(features, 1, grain, only=month)
    preds = bt.all_predictions(features, [champion, challenger], windows)
    m = bt.metrics(preds, ["predictor"])
    cur = m.where(F.col("predictor") == champion.name).select("mae").scalar()
    cand = m.where(F.col("predictor") == challenger.name).select("mae").scalar()
    required = cur * (1 - min_improvement)
    ok = cand <= required
    return m.agg(F.count(F.lit(1))).select(
        F.when(ok, F.lit("promoted")).otherwise(F.lit("kept")).alias("status"), ok.alias("promoted"),
        F.lit(month).alias("eval_month"), F.round(cand, 4).alias("mae_candidate"), F.round(cur, 4).alias("mae_current"),
        F.round(required, 4).alias("required_candidate_mae"), F.lit(float(min_improvement)).alias("min_improvement"),
        F.lit(champion_meta["model_version"]).alias("current_version"))


class StaleDecision(RuntimeError):
    """Another decision was recorded since this one's champion was read."""


def decisions(spark, registry_path: str) -> list[tuple[int, dict]]:
    """(number, decision) in the order in which they were recorded."""
    return records(spark, registry_path)


def record_decision(decision: DataFrame, registry_path: str, new_version: str | None = None, artifact_path: str | None = None,
                    after: int | None = None) -> DataFrame:
    """Records a one-row decision as number ``after`` + 1 (``after``: the newest
    number when the champion was read; by default the newest now). If another
    decision has that number, it raises ``StaleDecision`` and records nothing.
    The current model is the newest promoted one: a pointer instead of a
    directory swap. Returns the decision with its number."""
    spark = decision.sparkSession
    if after is None:
        after = max([n for n, _ in decisions(spark, registry_path)], default=0)
    row = decision.first().asDict()
    record = row | {"new_version": new_version, "artifact_path": artifact_path, "decided_at": dt.datetime.now(dt.timezone.utc).isoformat()}
    if not commit(spark, registry_path, after + 1, record):
        raise StaleDecision(f"decision {after + 1} was recorded by another promotion")
    return (decision.withColumn("new_version", F.lit(new_version).cast("string")).withColumn("artifact_path", F.lit(artifact_path).cast("string"))
            .withColumn("number", F.lit(after + 1)))


def current_model(spark, registry_path: str) -> DataFrame:
    """The newest promoted model: (number, new_version, artifact_path, eval_month); no row before a promotion."""
    promoted = [(n, d["new_version"], d["artifact_path"], d["eval_month"]) for n, d in decisions(spark, registry_path) if d["promoted"]]
    return spark.createDataFrame(promoted[-1:], "number int, new_version string, artifact_path string, eval_month string")


def current_version(spark, registry_path: str) -> str | None:
    r = current_model(spark, registry_path).first()
    return r["new_version"] if r else None


def run_promotion(features: DataFrame, champion: Artifact, cfg: Config, models_dir: str, registry_path: str, version: str,
                  min_improvement: float = 0.02, feature_list: list[str] | None = None, kind: str = "gbt") -> DataFrame:
    """Challenge the champion on the newest full month that it has not seen.

    A challenger is fitted on everything before that month and both predict it.
    If the challenger wins it is fitted again through the newest bucket and saved
    as ``models_dir/version``; a version that exists is refused before any work.
    The decision is recorded either way and returned; when another promotion has
    recorded one in the meantime, ``StaleDecision`` is raised, as the champion
    may have changed.
    """
    spark = features.sparkSession
    after = max([n for n, _ in decisions(spark, registry_path)], default=0)
    home = f"{models_dir}/{version}"
    if has_data(spark, home):
        raise ValueError(f"model version {version} is already archived in {models_dir}")
    through = dt.datetime.fromisoformat(str(champion.metadata["train_through"]))
    month = latest_unseen_full_month(features, through, cfg.grain)
    incumbent = ArtifactPredictor(champion, "champion")
    if month is None:
        return record_decision(promote_if_better(features, incumbent, incumbent, champion.metadata, cfg.grain, min_improvement), registry_path, after=after)
    start = dt.datetime.strptime(month, "%Y-%m")
    trial = train_production(features.where(F.col("hour") < F.lit(start)), cfg, f"{models_dir}/_trial-{version}", None, kind, feature_list)
    decision = promote_if_better(features, incumbent, ArtifactPredictor(trial, "challenger"), champion.metadata, cfg.grain, min_improvement)
    decision = materialize(decision, "table")
    if not decision.first()["promoted"]:
        return record_decision(decision, registry_path, after=after)
    train_production(features, cfg, home, None, kind, feature_list)
    return record_decision(decision, registry_path, version, home, after)
