import numpy as np
import pytest

from tallycast.operators import clustering as cl


def frame(spark, x, parts=3):
    rows = [(f"s{i:03d}", *map(float, row)) for i, row in enumerate(x)]
    return spark.createDataFrame(rows, "station_id string, " + ", ".join(f"`{s}` double" for s in cl.SLOTS)).repartition(parts)


def brute(x, k, seed, n_init, scale):
    keys = [f"s{i:03d}" for i in range(len(x))]
    whole = np.rint(x * scale).astype(np.int64)
    x, found = whole / scale, []
    for r in range(n_init):
        c = np.zeros((0, x.shape[1]))
        for pick in range(k):
            far = ((x[:, None] - c[None]) ** 2).sum(2).min(1) if pick else np.ones(len(x))
            races = [(-np.log(cl.uniform(key, seed, r, pick)) / d if d > 0 else np.inf, key) for key, d in zip(keys, far)]
            c = np.vstack([c, x[races.index(min(races))]])
        while True:
            d = ((x[:, None] - c[None]) ** 2).sum(2)
            at = d.argmin(1)
            cost = np.rint(d.min(1) * scale).astype(np.int64).sum()
            new = np.array([whole[at == j].sum(0) / (at == j).sum() / scale if (at == j).any() else c[j] for j in range(k)])
            if (new == c).all():
                break
            c = new
        found.append((cost, r, at))
    return dict(zip(keys, map(str, min(found, key=lambda f: f[:2])[2])))


def test_equals_brute_force_over_all_restarts(spark):
    rng = np.random.default_rng(2)
    x = rng.dirichlet(np.ones(48) * 0.4, 60) * 0.5 + rng.dirichlet(np.ones(48) * 0.1, 6)[rng.integers(6, size=60)] * 0.5
    x[:3] = 0.0
    got = {r.station_id: r.cluster for r in cl.cluster_stations(frame(spark, x), k=5, seed=7, n_init=4).collect()}
    assert got == brute(x, 5, 7, 4, float(1 << 40))
    assert got == {r.station_id: r.cluster for r in cl.cluster_stations(frame(spark, x, 1), k=5, seed=7, n_init=4).collect()}


def test_few_series_and_guards(spark):
    x = np.eye(48)[[0, 0, 1]]
    got = {r.station_id: r.cluster for r in cl.cluster_stations(frame(spark, x), k=5, n_init=2).collect()}
    assert got["s000"] == got["s001"] != got["s002"]
    assert cl.cluster_stations(frame(spark, x).limit(0)).count() == 0
    twice = spark.createDataFrame([("a", "1"), ("a", "2")], "station_id string, cluster string")
    with pytest.raises(ValueError, match="more than once"):
        cl.add_cluster_feature(twice.select("station_id"), twice)
    one = spark.createDataFrame([("a",), ("b",)], "station_id string")
    assert {(r.station_id, r.cluster) for r in cl.add_cluster_feature(one, twice.limit(1)).collect()} == {("a", "1"), ("b", "unknown")}
