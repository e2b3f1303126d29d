"""Series products: scope, bucket counts, dense key x time grid, lifetime trim,
station master and station-month panel."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import Config, Grain
from ..functions.calendar import phase_expr
from ..functions.exprs import bounded_broadcast, bucket, month_str, prefix_sums


def _zero_fill(zeros: DataFrame, counts: DataFrame, key: str, phase: Grain | None) -> DataFrame:
    """Merge zero rows and counts with one aggregation. With ``phase`` the rows
    are hash-partitioned by (key, phase) first and the phase column is kept, so
    the aggregation and the later lag window need no further exchange."""
    u = zeros.unionByName(counts.select(key, "hour", "trips"))
    if phase is None:
        return u.groupBy(key, "hour").agg(F.sum("trips").cast("int").alias("trips"))
    name, expr = phase_expr(phase.unit)
    u = u.withColumn(name, expr).repartition(key, name)
    return (u.groupBy(key, name, "hour").agg(F.sum("trips").cast("int").alias("trips"))
            .select(key, "hour", "trips", name))


def select_scope(clean: DataFrame, n: int, lookback_days: int = 365, key: str = "station_id",
                 ts: str = "started_at") -> DataFrame:
    """Top-n keys by volume in the ``lookback_days`` before the latest start
    (inclusive). Ties are broken by key. Result has at most ``n`` rows."""
    cutoff = clean.select(F.timestamp_add("DAY", F.lit(-lookback_days), F.max(ts))).scalar()
    return (clean.where(F.col(ts) >= cutoff)
            .groupBy(key).agg(F.count(F.lit(1)).alias("trips"))
            .orderBy(F.desc("trips"), F.asc(key)).limit(n))


def series_counts(clean: DataFrame, scope: DataFrame | None, grain: Grain, key: str = "station_id",
                  ts: str = "started_at") -> DataFrame:
    """Count rows per (key, bucket) within the scope (semi join; the scope is
    bounded by ``top_n`` so it is broadcast)."""
    df = clean
    if scope is not None:
        df = df.join(bounded_broadcast(scope.select(key)), key, "left_semi")
    return (df.select(key, bucket(ts, grain.unit).alias("hour"))
            .groupBy(key, "hour").agg(F.count(F.lit(1)).cast("int").alias("trips")))


def full_grid(counts: DataFrame, keys: DataFrame, grain: Grain, key: str = "station_id",
              phase: Grain | None = None) -> DataFrame:
    """Dense grid keys x buckets from the first to the last bucket of ``counts``
    (both inclusive), zero-filled. The bucket range is a scalar subquery and the
    grid is an ``explode(sequence)`` per key (no nested-loop join); zero rows
    and counts are merged by one aggregation instead of a join."""
    bounds = counts.agg(F.min("hour").alias("lo"), F.max("hour").alias("hi"))
    lo = bounds.select("lo").scalar()
    hi = bounds.select("hi").scalar()
    zeros = keys.select(key).distinct().select(
        key, F.explode(F.sequence(lo, hi, F.expr(grain.interval))).alias("hour"),
        F.lit(0).alias("trips"))
    return _zero_fill(zeros, counts, key, phase)


def lifetime_grid(counts: DataFrame, clean: DataFrame, scope: DataFrame, grain: Grain,
                  key: str = "station_id", ts: str = "started_at", phase: Grain | None = None) -> DataFrame:
    """``trim_to_lifetime(full_grid(...))`` generated directly: each scope key
    explodes only the buckets from max(first bucket, its first month) to the
    last bucket, so no trimming join/filter runs over the full grid. Keys
    without clean rows (no first month) get no rows, as in the trim."""
    bounds = counts.agg(F.min("hour").alias("lo"), F.max("hour").alias("hi"))
    lo = bounds.select("lo").scalar()
    hi = bounds.select("hi").scalar()
    fm = first_month(clean.join(bounded_broadcast(scope.select(key)), key, "left_semi"), key, ts)
    start = F.greatest(lo, F.col("first_month"))
    seq = F.when(start <= hi, F.sequence(start, hi, F.expr(grain.interval)))
    zeros = (bounded_broadcast(fm).select(key, F.explode(seq).alias("hour"), F.lit(0).alias("trips")))
    return _zero_fill(zeros, counts, key, phase)


def first_month(clean: DataFrame, key: str = "station_id", ts: str = "started_at") -> DataFrame:
    return clean.groupBy(key).agg(bucket(F.min(ts), "month").alias("first_month"))


def trim_to_lifetime(grid: DataFrame, clean: DataFrame, key: str = "station_id",
                     scope: DataFrame | None = None) -> DataFrame:
    """Drop grid rows before the month a key was first seen (over all clean rows).
    A grid key without any clean row is dropped (null comparison)."""
    fm = first_month(clean, key)
    if scope is not None:
        fm = bounded_broadcast(fm.join(bounded_broadcast(scope.select(key)), key, "left_semi"))
    return (grid.join(fm, key, "left").where(F.col("hour") >= F.col("first_month")).drop("first_month"))


def grid_identity(grid: DataFrame, key: str = "station_id") -> DataFrame:
    """rows == distinct keys x distinct buckets (one row)."""
    return (grid.agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct(key).alias("n_keys"),
                     F.count_distinct("hour").alias("n_hours"))
            .withColumn("expected_rows", F.col("n_keys") * F.col("n_hours"))
            .withColumn("is_complete", F.col("n_rows") == F.col("expected_rows")))


def assert_grid_complete(grid: DataFrame, key: str = "station_id") -> None:
    r = grid_identity(grid, key).first()
    if not r["is_complete"]:
        raise ValueError(f"grid is not dense: {r['n_rows']} rows != {r['n_keys']} x {r['n_hours']}")


def exact_medians(rows: DataFrame, key: str, cols: list[str]) -> DataFrame:
    """(key, *cols): the exact median of every column per key, nulls left out.
    Values are counted per key first; the middle ranks are found by distributed
    prefix sums, so no key's values are gathered, whatever their number."""
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("col"), F.col(c).cast("double").alias("value")) for c in cols]))
    counted = (rows.select(key, pairs.alias("p")).select(key, "p.*").where(F.col("value").isNotNull())
               .groupBy(key, "col", "value").agg(F.count(F.lit(1)).alias("n")))
    ranked = prefix_sums(counted, [key, "col"], "value", ["n"])
    low, high = F.floor((F.col("n_total") - 1) / 2), F.floor(F.col("n_total") / 2)
    at = lambda r: F.when((F.col("n_upto") - F.col("n") <= r) & (r < F.col("n_upto")), F.col("value"))
    mid = lambda c: (F.max(F.when(F.col("col") == c, at(low))) + F.max(F.when(F.col("col") == c, at(high)))) / 2
    return ranked.groupBy(key).agg(*[mid(c).alias(c) for c in cols])


def station_master(clean: DataFrame, cfg: Config | None = None, key: str = "station_id") -> DataFrame:
    """Per key: modal non-null name (ties -> smallest), exact median coordinates,
    volume, first/last ``yyyy-MM``. Names are counted per (key, name) and medians
    from per-value counts, so a hot key is never gathered in one task."""
    names = (clean.where(F.col("start_station_name").isNotNull()).groupBy(key, "start_station_name").agg(F.count(F.lit(1)).alias("n"))
             .groupBy(key).agg(F.min(F.struct((-F.col("n")).alias("n"), F.col("start_station_name").alias("name"))).alias("_top")))
    base = clean.groupBy(key).agg(
        F.count(F.lit(1)).alias("total_trips"),
        month_str(F.min("started_at")).alias("first_month"),
        month_str(F.max("started_at")).alias("last_month"))
    medians = exact_medians(clean, key, ["start_lat", "start_lng"]).withColumnsRenamed({"start_lat": "lat", "start_lng": "lng"})
    return (base.join(names, key, "left").join(medians, key, "left")
            .select(key, F.col("_top.name").alias("name"), "lat", "lng", "total_trips", "first_month", "last_month"))


def station_month_panel(clean: DataFrame, key: str = "station_id",
                        types: tuple[str, str] = ("member", "casual")) -> DataFrame:
    """Counts by key and month split by rider type (missing -> 0). Types beyond
    the listed ones get a ``<type>_trips`` column each, after the total, which
    counts the listed ones; a null type is counted nowhere."""
    found = [r[0] for r in clean.select("member_casual").distinct().collect()]  # a handful of rider types
    extra = sorted(t for t in found if t is not None and t not in types)
    p = (clean.withColumn("month", month_str("started_at"))
         .groupBy(key, "month").pivot("member_casual", [*types, *extra]).agg(F.count(F.lit(1))))
    n = lambda t: F.coalesce(F.col(f"`{t}`"), F.lit(0)).cast("int")
    m, c = types
    return p.select(key, "month", n(m).alias("member_trips"), n(c).alias("casual_trips"), (n(m) + n(c)).cast("int").alias("total_trips"),
                    *[n(t).alias(f"{t}_trips") for t in extra])


def build_grid(clean: DataFrame, cfg: Config, key: str = "station_id", trim: bool = True) -> DataFrame:
    """scope -> counts -> dense grid -> lifetime trim."""
    scope = select_scope(clean, cfg.top_n, cfg.scope_lookback_days, key)
    counts = series_counts(clean, scope, cfg.grain, key)
    if trim:
        return lifetime_grid(counts, clean, scope, cfg.grain, key)
    return full_grid(counts, scope, cfg.grain, key)
