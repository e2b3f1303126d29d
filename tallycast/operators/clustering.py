"""Demand-shape profiles per series and k-means clusters.

All restarts of k-means run together: a job per step finds the nearest centre of
every restart for every series and adds up the members, so ten restarts take as
many jobs as the slowest of them. Sums are of fixed-point numbers, so centres,
costs and labels do not depend on the layout of the data.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..functions.calendar import iso_dow
from ..functions.exprs import hsum, materialize

MAX_STEPS = 300

SLOTS = [f"{w}_{h}" for w in (0, 1) for h in range(24)]


def station_profiles(grid: DataFrame, key: str = "station_id") -> DataFrame:
    """48 slots (weekday/weekend x hour) of mean counts, missing -> 0,
    L1-normalised per key; an all-zero profile stays zero."""
    g = grid.select(key, "trips", F.concat_ws("_", (iso_dow(F.col("hour")) >= 6).cast("int").cast("string"),
                                             F.hour("hour").cast("string")).alias("slot"))
    p = g.groupBy(key).pivot("slot", SLOTS).agg(F.avg("trips"))
    p = p.select(key, *[F.coalesce(F.col(s), F.lit(0.0)).alias(s) for s in SLOTS])
    total = hsum([F.col(s) for s in SLOTS])
    return p.select(key, *[F.when(total > 0, F.col(s) / total).otherwise(F.lit(0.0)).alias(s) for s in SLOTS])


def uniform(key, seed: int, restart: int, pick: int) -> float:
    """A number in (0, 1] that a series draws for one pick of one restart."""
    digest = hashlib.blake2b(f"{seed}/{restart}/{pick}/{key}".encode(), digest_size=8).digest()
    return (int.from_bytes(digest, "big") + 1) / 2 ** 64


def distances(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """(rows, centres) of squared distances, summed term by term."""
    return ((x[:, None, :] - centres[None]) ** 2).sum(2)


def _start_centres(points: DataFrame, k: int, seed: int, n_init: int, scale: float) -> np.ndarray:
    """k-means++ for all restarts, one job a pick: the series with the least
    -log(u) / squared distance is one drawn in proportion to that distance."""
    chosen = np.zeros((n_init, 0, 0))
    for pick in range(k):
        def run(batches, chosen=chosen, pick=pick):
            best: dict[int, tuple] = {}
            for b in batches:
                keys, x = b.column(0).to_pylist(), np.array(b.column(1).to_pylist(), np.int64) / scale
                for r in range(n_init):
                    far = distances(x, chosen[r]).min(1) if pick else np.ones(len(keys))
                    for key, d, row in zip(keys, far, b.column(1)):
                        race = -np.log(uniform(key, seed, r, pick)) / d if d > 0 else np.inf
                        if r not in best or (race, key) < best[r][:2]:
                            best[r] = (float(race), key, row)
            rows = [(r, *v[:2], v[2].as_py()) for r, v in best.items()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(list(zip(*rows)) or [()] * 4, (pa.int32(), pa.float64(), pa.string(), pa.list_(pa.int64())))],
                                             ["r", "race", "key", "x"])

        won = (points.mapInArrow(run, "r int, race double, key string, x array<long>")
               .groupBy("r").agg(F.min_by("x", F.struct("race", "key")).alias("x")).orderBy("r").collect())
        new = np.array([w["x"] for w in won], np.int64)[:, None] / scale
        chosen = new if not pick else np.concatenate([chosen, new], 1)
    return chosen


def _members(points: DataFrame, centres: dict[int, np.ndarray], scale: float) -> dict[int, tuple[np.ndarray, np.ndarray, int]]:
    """restart -> (sums of the members per centre, their numbers, cost), all whole numbers."""
    def run(batches):
        sums = {r: np.zeros((len(c), c.shape[1] + 2), np.int64) for r, c in centres.items()}
        for b in batches:
            whole = np.array(b.column(1).to_pylist(), np.int64)
            if not len(whole):
                continue
            for r, c in centres.items():
                d = distances(whole / scale, c)
                at = d.argmin(1)
                cost = np.rint(d[np.arange(len(at)), at] * scale).astype(np.int64)
                np.add.at(sums[r], at, np.column_stack([whole, np.ones(len(at), np.int64), cost]))
        cells = [(r, i, j, int(v)) for r, t in sums.items() for (i, j), v in np.ndenumerate(t) if v]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(list(zip(*cells)) or [()] * 4, (pa.int32(), pa.int32(), pa.int32(), pa.int64()))], ["r", "c", "d", "v"])

    # restarts x centres x dimensions numbers
    got = points.mapInArrow(run, "r int, c int, d int, v long").groupBy("r", "c", "d").agg(F.sum("v").alias("v")).collect()
    out = {r: np.zeros((len(c), c.shape[1] + 2), np.int64) for r, c in centres.items()}
    for row in got:
        out[row["r"]][row["c"], row["d"]] = row["v"]
    return {r: (t[:, :-2], t[:, -2], int(t[:, -1].sum())) for r, t in out.items()}


def cluster_stations(profiles: DataFrame, k: int = 5, seed: int = 42, n_init: int = 10, key: str = "station_id") -> DataFrame:
    """(key, cluster): k-means of the profile vectors; of ``n_init`` restarts the
    one of least cost wins, the first of equals. Lloyd steps end when no centre
    moves. A centre without members stays where it is; label numbers are
    arbitrary. No series, no rows; with fewer distinct profiles than ``k`` some
    centres coincide and the first of them takes the members."""
    n = profiles.count()
    if not n:
        return profiles.select(key, F.lit("").alias("cluster"))
    scale = float(1 << min(40, 60 - n.bit_length()))
    points = materialize(profiles.select(F.col(key).cast("string").alias("key"), F.array(*[F.round(F.col(s) * scale).cast("long") for s in SLOTS]).alias("x")), "table")
    centres = dict(enumerate(_start_centres(points, k, seed, n_init, scale)))
    costs, moving = {}, dict(centres)
    for _ in range(MAX_STEPS):
        for r, (sums, members, cost) in _members(points, moving, scale).items():
            new = np.where(members[:, None] > 0, sums / np.maximum(members, 1)[:, None] / scale, moving[r])
            costs[r] = cost
            if (new == moving[r]).all():
                del moving[r]
            else:
                centres[r] = moving[r] = new
        if not moving:
            break
    best = centres[min(costs, key=lambda r: (costs[r], r))]

    def label(batches):
        for b in batches:
            x = np.array(b.column(1).to_pylist(), np.int64).reshape(-1, best.shape[1]) / scale
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([str(c) for c in distances(x, best).argmin(1)], pa.string())], [key, "cluster"])

    return points.mapInArrow(label, StructType([StructField(key, StringType()), StructField("cluster", StringType())]))


def add_cluster_feature(df: DataFrame, clusters: DataFrame, key: str = "station_id") -> DataFrame:
    """Left join of the cluster, ``unknown`` where a key has none; a key listed
    twice is an error, as it would multiply rows."""
    twice = clusters.groupBy(key).agg(F.count(F.lit(1)).alias("n")).where("n > 1").limit(5).collect()
    if twice:
        raise ValueError(f"clusters list {[r[0] for r in twice]} more than once")
    return df.join(clusters.select(key, "cluster"), key, "left").withColumn("cluster", F.coalesce(F.col("cluster"), F.lit("unknown")))
