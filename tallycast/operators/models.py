"""Count models and the model-artifact contract.

Three kinds: ``poisson_trees`` (boosted trees with Poisson loss, see
``poisson_trees.py``, where missing values and unseen categories follow each
split's default branch), and on Spark ML ``gbt`` (boosted trees with squared
loss, predictions clamped at 0) and ``glm`` (Poisson with log link). For these
two the series key is a categorical frozen at fit time
(``StringIndexer(handleInvalid='keep')``): an unseen key scores as the
'unknown' level instead of failing. Target-derived features may be null
(short history); they are imputed with 0 plus a ``<col>_missing`` indicator,
with the same code for training and serving (VectorAssembler rejects nulls).
"""

from __future__ import annotations

import datetime as dt
import json
import uuid

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import OneHotEncoder, StringIndexer, StringIndexerModel, VectorAssembler
from pyspark.ml.regression import GBTRegressor, GeneralizedLinearRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import Config
from ..functions.exprs import materialize
from . import backtest as bt
from . import poisson_trees as pt
from .poisson_trees import FitSpec, PoissonModel

KEY = "station_id"
CODE_VERSION = "3"  # of the feature and model code an artifact was fitted by


def _target_derived(cols):
    return [c for c in cols if c.startswith("lag_") or c.startswith("roll_mean_")]


def categorical_columns(df: DataFrame, features: list[str]) -> list[str]:
    """The series key and every other feature that is a string."""
    kinds = dict(df.dtypes)
    return [c for c in features if c == KEY or kinds[c] == "string"]


def prepare(df: DataFrame, features: list[str]) -> tuple[DataFrame, list[str], list[str]]:
    """(frame, numeric design columns, categorical columns): booleans become
    numbers, null numbers 0 (with an indicator for target-derived ones), null
    categories a level of their own."""
    cats = categorical_columns(df, features)
    numeric = [c for c in features if c not in cats]
    out, cols = df, []
    for c in numeric:
        v = F.col(c).cast("double")
        if c in _target_derived(numeric):
            out = out.withColumn(f"_x_{c}_missing", v.isNull().cast("double"))
            cols.append(f"_x_{c}_missing")
        out = out.withColumn(f"_x_{c}", F.coalesce(v, F.lit(0.0)))
        cols.append(f"_x_{c}")
    for c in cats:
        out = out.withColumn(f"_cat_{c}", F.coalesce(F.col(c).cast("string"), F.lit("unknown")))
    return out, cols, cats


def time_based_split(train: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Validation = last calendar month present; error with fewer than two months."""
    span = train.agg(F.min("hour").alias("lo"), F.max("hour").alias("hi")).first()
    start = span["hi"] and dt.datetime(span["hi"].year, span["hi"].month, 1)
    if start is None or span["lo"] >= start:
        raise ValueError("need at least two calendar months to hold out a validation month")
    return train.where(F.col("hour") < F.lit(start)), train.where(F.col("hour") >= F.lit(start))


def _pipeline(kind: str, design: list[str], params: dict, cats: list[str], levels: int) -> Pipeline:
    stages = []
    inputs = list(design)
    for c in cats:
        stages.append(StringIndexer(inputCol=f"_cat_{c}", outputCol=f"_idx_{c}", handleInvalid="keep"))
        if kind == "glm":
            stages.append(OneHotEncoder(inputCols=[f"_idx_{c}"], outputCols=[f"_vec_{c}"], handleInvalid="keep"))
        inputs.append(f"_vec_{c}" if kind == "glm" else f"_idx_{c}")
    stages.append(VectorAssembler(inputCols=inputs, outputCol="_features", handleInvalid="keep"))
    if kind == "glm":
        stages.append(GeneralizedLinearRegression(family="poisson", link="log", featuresCol="_features",
                                                  labelCol="_label", predictionCol="_pred",
                                                  maxIter=int(params.get("max_iter", 25)),
                                                  regParam=float(params.get("reg_param", 1e-3))))
    else:
        stages.append(GBTRegressor(featuresCol="_features", labelCol="_label", predictionCol="_pred",
                                   maxIter=int(params.get("max_iter", 50)), maxDepth=int(params.get("max_depth", 6)),
                                   stepSize=float(params.get("step_size", 0.1)), maxBins=max(32, levels + 2),
                                   seed=int(params.get("seed", 7))))
    return Pipeline(stages=stages)


def usable_rows(frame: DataFrame, features: list[str]) -> DataFrame:
    """Rows that may train a model: none of their target-derived features is null."""
    tgt = _target_derived(features)
    return frame.dropna(subset=tgt) if tgt else frame


def month_start(t: dt.datetime) -> dt.datetime:
    return dt.datetime(t.year, t.month, 1)


def _fit_poisson(train: DataFrame, features: list[str], params: dict, refit_full: bool) -> tuple[PoissonModel, float]:
    rows = usable_rows(train, features)
    span = rows.agg(F.min("hour").alias("lo"), F.max("hour").alias("hi")).first()
    start = span["hi"] and month_start(span["hi"])
    if start is None or span["lo"] >= start:
        raise ValueError("need at least two calendar months to hold out a validation month")
    end = span["hi"] + dt.timedelta(microseconds=1)
    model = pt.fit_many(rows, [FitSpec("selection", tuple(features), params, start, end)])[0]
    if not refit_full:
        return model, model.val_mae
    full = pt.fit_many(rows, [FitSpec("full", tuple(features), dict(params, n_estimators=max(1, len(model.trees))), end)])[0]
    full.val_mae = model.val_mae
    return full, model.val_mae


def fit_model(train: DataFrame, features: list[str], params: dict, kind: str = "gbt",
              refit_full: bool = True):
    """Drop training rows with null target-derived features, hold out the last
    month, pick the tree count by validation MAE (GBT), refit on all rows.
    Returns (model, validation MAE); without the refit the model has the picked
    number of trees, too, and so has the validation MAE."""
    if kind == "poisson_trees":
        return _fit_poisson(train, features, params, refit_full)
    rows = usable_rows(train, features)
    rows, design, cats = prepare(rows.withColumn("_label", F.col("trips").cast("double")), features)
    rows = materialize(rows, "table")
    fit_part, valid = time_based_split(rows)
    levels = max(rows.agg(*[F.count_distinct(f"_cat_{c}") for c in cats]).first()) if cats else 0
    model = _pipeline(kind, design, params, cats, levels).fit(fit_part)
    p = dict(params)
    if kind == "gbt":
        gbt = model.stages[-1]
        prepared_valid = PipelineModel(model.stages[:-1]).transform(valid)
        errs = gbt.evaluateEachIteration(prepared_valid, "absolute")
        p["max_iter"] = min(range(len(errs)), key=lambda i: errs[i]) + 1
        if p["max_iter"] < len(errs):
            # boosting with the same seed: the first trees are the same ones
            model = _pipeline(kind, design, p, cats, levels).fit(fit_part)
    scored = model.transform(valid)
    val_mae = scored.agg(F.avg(F.abs(F.greatest(F.col("_pred"), F.lit(0.0)) - F.col("_label")))).first()[0]
    if refit_full:
        model = _pipeline(kind, design, p, cats, levels).fit(rows)
    return model, float(val_mae) if val_mae is not None else float("nan")


def fitted_trees(model) -> int | None:
    if isinstance(model, PoissonModel):
        return len(model.trees)
    return model.stages[-1].getNumTrees if hasattr(model.stages[-1], "getNumTrees") else None


def categories(model) -> dict[str, list[str]]:
    """The frozen levels of every categorical feature."""
    if isinstance(model, PoissonModel):
        return model.bins.levels
    return {s.getInputCol().removeprefix("_cat_"): list(s.labels) for s in model.stages if isinstance(s, StringIndexerModel)}


def score(model, frame: DataFrame, features: list[str]) -> DataFrame:
    """Non-negative predictions for every row (no nulls)."""
    if isinstance(model, PoissonModel):
        return model.score(frame)
    prepared, _, _ = prepare(frame, features)
    out = model.transform(prepared)
    keep = [c for c in frame.columns]
    return out.select(*keep, F.greatest(F.coalesce(F.col("_pred"), F.lit(0.0)), F.lit(0.0)).alias("prediction"))


def window_specs(features: DataFrame, windows: DataFrame, name: str, feature_list: list[str], params: dict) -> dict[str, FitSpec]:
    """window -> fit on the months before it, the last of which chooses the number of trees."""
    out = {}
    for r in windows.select("window", "cutoff").orderBy("window").collect():  # <= n_windows rows
        if r["cutoff"] is None:
            raise ValueError(f"no month before {r['window']} to train on")
        out[r["window"]] = FitSpec(f"{name}/{r['window']}", tuple(feature_list), params, month_start(r["cutoff"]), dt.datetime.strptime(r["window"], "%Y-%m"))
    return out


def window_rows(features: DataFrame, window: str) -> DataFrame:
    start = dt.datetime.strptime(window, "%Y-%m")
    end = dt.datetime(start.year + start.month // 12, start.month % 12 + 1, 1)
    return features.where((F.col("hour") >= F.lit(start)) & (F.col("hour") < F.lit(end)))


class ModelPredictor:
    """Backtest predictor: one fit per window on the rows of earlier months; the
    Poisson trees of all windows are fitted together."""

    def __init__(self, name: str, features: list[str], params: dict, kind: str = "gbt"):
        self.name, self.features, self.params, self.kind = name, features, params, kind

    def predict_all(self, features: DataFrame, windows: DataFrame) -> DataFrame:
        if self.kind == "poisson_trees":
            specs = window_specs(features, windows, self.name, self.features, self.params)
            fitted = dict(zip(specs, pt.fit_many(usable_rows(features, self.features), list(specs.values()))))
        else:
            # <= n_windows values
            fitted = {w: fit_model(features.where(F.col("hour") < F.lit(dt.datetime.strptime(w, "%Y-%m"))), self.features, self.params, self.kind,
                                   refit_full=False)[0] for (w,) in windows.select("window").orderBy("window").collect()}
        out = None
        for w, model in fitted.items():
            d = score(model, window_rows(features, w), self.features).select(F.lit(w).alias("window"), KEY, "hour", "trips", "prediction")
            out = d if out is None else out.unionByName(d)
        return out


class Artifact:
    """A fitted model plus its metadata (same feature list for train and serve)."""

    def __init__(self, model, metadata: dict):
        self.model, self.metadata = model, metadata

    def score(self, frame: DataFrame) -> DataFrame:
        return score(self.model, frame, self.metadata["features"])


class NaiveArtifact:
    """Seasonal-naive 'artifact' (no fit): prediction = weekly lag, null -> 0."""

    def __init__(self, naive_lag: str, version: str = "seasonal-naive-v1", train_through: str = "1900-01-01"):
        self.naive_lag = naive_lag
        self.metadata = {"model_version": version, "train_through": train_through, "val_mae": None,
                         "features": [naive_lag]}

    def score(self, frame: DataFrame) -> DataFrame:
        return frame.withColumn("prediction", F.coalesce(F.col(self.naive_lag).cast("double"), F.lit(0.0)))


def train_production(features: DataFrame, cfg: Config, out_dir: str, through: dt.date | None = None,
                     kind: str = "gbt", feature_list: list[str] | None = None) -> Artifact:
    """Cutoff -> fit with refit -> save the model + one-row metadata JSON."""
    if through is not None:
        end = dt.datetime(through.year, through.month, through.day, 23)
        features = features.where(F.col("hour") <= F.lit(end))
    rng = features.agg(F.min("hour").alias("lo"), F.max("hour").alias("hi")).first()
    if rng["hi"] is None:
        raise ValueError("no training rows through the requested cutoff")
    flist = feature_list or cfg.model_features
    params = cfg.params_of(kind)
    model, val_mae = fit_model(features, flist, params, kind, refit_full=True)
    meta = {"schema_version": 1, "features": flist, "params": {k: str(v) for k, v in params.items()},
            "categories": categories(model), "fitted_n_estimators": fitted_trees(model), "code_version": CODE_VERSION,
            "data_range": [str(rng["lo"]), str(rng["hi"])], "train_through": str(rng["hi"]), "val_mae": val_mae,
            "model_version": f"{kind}-{str(rng['hi'])[:10]}-{uuid.uuid4().hex[:8]}",
            "created_at": dt.datetime.now(dt.timezone.utc).isoformat(), "kind": kind}
    meta["path"] = out_dir
    spark = features.sparkSession
    if isinstance(model, PoissonModel):
        spark.createDataFrame([(model.to_json(),)], "model string").coalesce(1).write.mode("overwrite").text(f"{out_dir}/model")
    else:
        model.write().overwrite().save(f"{out_dir}/model")
    spark.createDataFrame([(json.dumps(meta),)], "metadata string").coalesce(1).write.mode("overwrite").text(
        f"{out_dir}/metadata")
    return Artifact(model, meta)


def load_artifact(spark, out_dir: str) -> Artifact:
    meta = json.loads(spark.read.text(f"{out_dir}/metadata").first()[0])
    if meta["kind"] == "poisson_trees":
        return Artifact(PoissonModel.from_json(spark.read.text(f"{out_dir}/model").first()[0]), meta)
    return Artifact(PipelineModel.load(f"{out_dir}/model"), meta)


def feature_importance(model, features: list[str]) -> DataFrame:
    """Importances, descending: total split gain of Poisson trees, Spark ML's
    normalised impurity decrease of a GBT pipeline."""
    if isinstance(model, PoissonModel):
        return pt.feature_gains(model, _active_spark())
    gbt = model.stages[-1]
    assembler = [s for s in model.stages if isinstance(s, VectorAssembler)][0]
    names = assembler.getInputCols()
    imp = gbt.featureImportances.toArray().tolist()
    spark = _active_spark()
    rows = [(n.removeprefix("_x_").removeprefix("_idx_"), float(v)) for n, v in zip(names, imp)]
    return spark.createDataFrame(rows, "feature string, importance double").orderBy(F.desc("importance"), "feature")


def _active_spark():
    from pyspark.sql import SparkSession
    return SparkSession.getActiveSession()


class ArtifactPredictor:
    """A frozen artifact used through the backtest predictor protocol (no refit)."""

    def __init__(self, artifact, name: str = "current"):
        self.artifact, self.name = artifact, name

    def predict_all(self, features: DataFrame, windows: DataFrame) -> DataFrame:
        ev = bt.eval_rows(features, windows)
        return self.artifact.score(ev).select("window", KEY, "hour", "trips", F.col("prediction").cast("double"))
