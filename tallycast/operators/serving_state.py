"""Serving without history: the last values of every (key, phase).

Lags and same-phase rolling means of the next bucket of a phase need only the
last few values of that phase. The state holds them, newest first; each day's
counts are added to it, and the features of the coming buckets come from the
state alone. A state is staged and then committed like a forecast, so a day that
is advanced twice, or by a writer that dies, leaves one state a day.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import Config, Grain
from ..sources.commits import commit, records, records_by_folder
from . import features as feat
from .forecast import KEY, _step, last_known_bucket


def cycles(grain: Grain) -> int:
    """Values a phase that the features look back on."""
    return max(max(grain.lags) // grain.season, max(grain.rolling))


def initial_state(history: DataFrame, as_of: dt.date, grain: Grain) -> DataFrame:
    """(key, phase, last bucket, values newest first) at the end of ``as_of``,
    from the look-back that the features need; an error unless every key seen
    there has all of its buckets."""
    last = last_known_bucket(as_of, grain)
    since = last - _step(grain) * (cycles(grain) * grain.season - 1)
    recent = history.where((F.col("hour") >= F.lit(since)) & (F.col("hour") <= F.lit(last)))
    newest = F.array_sort(F.collect_list(F.struct((-F.unix_seconds(F.col("hour").cast("timestamp"))).alias("k"), F.col("trips").alias("v"))))
    state = recent.groupBy(KEY, feat.phase(grain).alias("phase")).agg(F.max("hour").alias("last"), F.transform(newest, lambda s: s["v"]).alias("recent"))
    return _complete(state, last, grain)


def _complete(state: DataFrame, last: dt.datetime, grain: Grain) -> DataFrame:
    """The state, if every key has all phases, each with all values and its last bucket in the last cycle."""
    short = (F.size("recent") != cycles(grain)) | (F.col("last") <= F.lit(last - _step(grain) * grain.season))
    per = state.groupBy(KEY).agg(F.count("*").alias("n"), F.count_if(short).alias("short")).where((F.col("n") != grain.season) | (F.col("short") > 0))
    bad = [r[KEY] for r in per.orderBy(KEY).limit(5).collect()]
    if bad:
        raise ValueError(f"history is incomplete through {last}, for instance of {bad}")
    return state


def advance(state: DataFrame, counts: DataFrame, as_of: dt.date, grain: Grain) -> DataFrame:
    """The state at the end of ``as_of``, given the state one day earlier and the
    counts (key, hour, trips) of that day. A key of the state without a count for
    one of the day's buckets, or with two, is an error; keys that the state does
    not know have too little history and wait for the next initial state."""
    last, step = last_known_bucket(as_of, grain), _step(grain)
    first = dt.datetime.combine(as_of, dt.time())
    day = counts.where((F.col("hour") >= F.lit(first)) & (F.col("hour") <= F.lit(last))).select(KEY, "hour", "trips", feat.phase(grain).alias("phase"))
    n = int((last - first) / step) + 1
    phases = F.array(*[F.lit(first + step * i).cast("timestamp_ntz") for i in range(n)])
    due = F.col("phase").isin([r[0] for r in state.sparkSession.range(1).select(F.explode(phases).alias("hour")).select(feat.phase(grain)).collect()])
    new = day.groupBy(F.col(KEY).alias("_k"), F.col("phase").alias("_p")).agg(F.max("hour").alias("_hour"), F.max("trips").alias("_trips"), F.count("*").alias("_n"))
    both = state.join(new, (F.col(KEY) == F.col("_k")) & (F.col("phase") == F.col("_p")), "left")
    wrong = both.where(due & ((F.coalesce("_n", F.lit(0)) != 1) | (F.col("last") != F.col("_hour") - F.expr(f"INTERVAL {grain.season} {grain.unit.upper()}"))))
    bad = [r[KEY] for r in wrong.select(KEY).distinct().orderBy(KEY).limit(5).collect()]
    if bad:
        raise ValueError(f"the counts of {as_of} do not follow the state, for instance of {bad}")
    moved = F.slice(F.concat(F.array("_trips"), F.col("recent")), 1, cycles(grain))
    return both.select(KEY, "phase", F.coalesce("_hour", "last").alias("last"), F.when(F.col("_hour").isNotNull(), moved).otherwise(F.col("recent")).alias("recent"))


def state_features(state: DataFrame, as_of: dt.date, cfg: Config, covariates: DataFrame | None = None, master: DataFrame | None = None,
                   check: bool = True) -> DataFrame:
    """The feature rows of the horizon after ``as_of``, as ``build_inference_features`` makes them from the history."""
    grain = cfg.grain
    feat.assert_no_leak(grain.lags, grain.horizon)
    if grain.horizon > grain.season:
        raise ValueError("the state serves one cycle at most")
    last = last_known_bucket(as_of, grain)
    hour = F.col("last") + F.expr(f"INTERVAL {grain.season} {grain.unit.upper()}")
    frame = state.select(KEY, hour.alias("hour"), F.lit(None).cast("int").alias("trips"), "recent")
    frame = frame.where(F.col("hour").between(F.lit(last + _step(grain)), F.lit(last + _step(grain) * grain.horizon)))
    frame = feat.add_calendar_features(frame)
    if covariates is not None:
        frame = feat.add_covariates(frame, covariates, cfg, check=check)
    if master is not None:
        frame = feat.add_station_features(frame, master, cfg if check else None)

    def mean(k: int):
        some = F.filter(F.slice("recent", 1, k), lambda v: v.isNotNull())
        return F.when(F.size(some) > 0, F.aggregate(some, F.lit(0).cast("double"), lambda a, v: a + v) / F.size(some))

    lags = [F.get("recent", F.lit(h // grain.season - 1)).alias(grain.lag_name(h)) for h in grain.lags]
    return frame.select(*[c for c in frame.columns if c != "recent"], *lags, *[mean(k).alias(grain.roll_name(k)) for k in grain.rolling])


def commit_state(state: DataFrame, path: str, as_of: dt.date) -> str:
    """Writes the state of a day and makes it visible, unless the day has one already."""
    spark = state.sparkSession
    if records(spark, f"{path}/commits/as_of={as_of.isoformat()}"):
        return "skipped"
    attempt = uuid.uuid4().hex
    state.write.parquet(f"{path}/data/{attempt}")
    return "written" if commit(spark, f"{path}/commits/as_of={as_of.isoformat()}", 1, {"attempt": attempt}) else "skipped"


def read_state(spark: SparkSession, path: str, as_of: dt.date | None = None) -> tuple[dt.date, DataFrame]:
    """(day, state) of the given or the newest day that has one."""
    found = {dt.date.fromisoformat(k.split("=", 1)[1]): v[0][1]["attempt"] for k, v in records_by_folder(spark, f"{path}/commits/as_of=*").items()}
    day = as_of or max(found, default=None)
    if day not in found:
        raise ValueError(f"no serving state for {as_of or 'any day'} in {path}")
    return day, spark.read.parquet(f"{path}/data/{found[day]}")
