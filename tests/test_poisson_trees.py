import datetime as dt
import math
import os

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tallycast.operators import poisson_trees as pt

START = dt.datetime(2025, 1, 1)


def data(n=700, seed=0, keys="ABCDE"):
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        k = keys[int(rng.integers(len(keys)))]
        x = None if rng.random() < 0.15 else float(rng.integers(0, 12))
        z = float(rng.normal())
        lam = math.exp(0.25 * (x or 6.0) - 1 + {"A": 1.0, "B": -1.0}.get(k, 0.0) + (0.8 if x is None else 0.0))
        rows.append((START + dt.timedelta(hours=i), k if rng.random() > 0.05 else None, x, z, bool(i % 3 == 0), int(rng.poisson(lam))))
    return rows


COLS = "hour timestamp_ntz, station_id string, x double, z double, flag boolean, trips int"
FEATURES = ("x", "station_id", "z", "flag")


def brute(rows, bins, spec, unit):
    """The same rules by masks over all rows: (base, trees as nested tuples, validation errors)."""
    p = spec.param()
    b = bins.T
    y = np.array([r[-1] for r in rows], float)
    train = np.array([r[0] < spec.fit_before for r in rows])
    held = np.array([spec.valid_before is not None and spec.fit_before <= r[0] < spec.valid_before for r in rows])
    base = math.log(y[train].mean())
    f = np.full(len(rows), base)
    trees, errors = [], []
    while True:
        if held.any():
            errors.append(np.rint(np.abs(np.exp(f[held]) - y[held]) * unit).sum() / unit / held.sum())
        if len(trees) >= p["n_estimators"]:
            break
        g, h = np.rint((np.exp(f) - y) * unit) / unit, np.rint(np.exp(f) * math.exp(0.7) * unit) / unit
        root = np.ones(len(rows), bool)
        leaves, nodes, depth = [root], [root], 0
        splits = []
        while nodes and len(leaves) < p["num_leaves"] and depth < p["max_depth"]:
            options = []
            for order, mask in enumerate(nodes):
                m = mask & train
                best = None
                for j, name in enumerate(FEATURES):
                    cat, bj = name == "station_id", b[:, j]
                    reg = p["l2"] + (10.0 if cat else 0.0)
                    values = [v for v in range(1, b[:, j].max() + 1)] if not cat else [v for v in sorted(set(bj[m])) if v]
                    if cat:
                        values.sort(key=lambda v: g[m & (bj == v)].sum() / (h[m & (bj == v)].sum() + 10.0))
                    some = (m & (bj == 0)).any()
                    for with_missing in ((False, True) if some else (False,)):
                        for k in range(1, len(values) + (1 if some else 0)):
                            left = np.isin(bj, values[:k] + ([0] if with_missing else []))
                            a, c = m & left, m & ~left
                            if a.sum() < p["min_child_samples"] or c.sum() < p["min_child_samples"]:
                                continue
                            score = (g[a].sum() ** 2 / (h[a].sum() + reg) + g[c].sum() ** 2 / (h[c].sum() + reg)
                                     - g[m].sum() ** 2 / (h[m].sum() + reg))
                            if score > 1e-9 and (best is None or score > best[0] * (1 + 1e-12)):
                                goes = left if some else left | ((bj == 0) & (a.sum() > c.sum()))
                                best = (score, name, goes)
                if best:
                    options.append((-best[0], order, best))
            options = sorted(options, key=lambda o: o[:2])[:p["num_leaves"] - len(leaves)]
            new = []
            for _, order, (score, name, left) in sorted(options, key=lambda o: o[1]):
                mask = nodes[order]
                splits.append((round(score, 6), name))
                pair = [mask & left, mask & ~left]
                leaves = [x for x in leaves if x is not mask] + pair
                new += pair
            nodes, depth = new, depth + 1
        for leaf in leaves:
            m = leaf & train
            f = f + np.where(leaf, -p["learning_rate"] * g[m].sum() / (h[m].sum() + p["l2"]), 0.0)
        trees.append(splits)
        if not splits:
            break
    return base, trees, errors, f


def spec(name="a", features=FEATURES, valid=True, cut=450, **params):
    return pt.FitSpec(name, features, {"n_estimators": 12, "num_leaves": 6, "min_child_samples": 10, "early_stopping": 99} | params,
                      START + dt.timedelta(hours=cut), START + dt.timedelta(hours=600) if valid else None)


def test_equals_brute_force_tree_by_tree(spark):
    rows = data()
    df = spark.createDataFrame(rows, COLS).repartition(5)
    specs = [spec(), spec("b", num_leaves=4, learning_rate=0.3, l2=1.0, cut=500, valid=False), spec("c", n_estimators=11, max_depth=2)]
    models = pt.fit_many(df, specs)
    for s, m in zip(specs, models):
        binned = m.bins.of([pa.array([float(r[i]) if isinstance(r[i], bool) else r[i] for r in rows]) for i in (2, 1, 3, 4)])
        base, trees, errors, f = brute(rows, binned, s, float(1 << 26))
        if errors:
            assert len(m.trees) == int(np.argmin(errors)) and abs(m.val_mae - min(errors)) < 1e-6
            trees = trees[:len(m.trees)]
        assert abs(m.base - base) < 1e-12 and len(m.trees) == len(trees)
        for t, want in zip(m.trees, trees):
            got = sorted((round(g, 6), m.bins.features[i]) for i, g in zip(t.feature, t.gain) if i >= 0)
            assert [x[1] for x in got] == [x[1] for x in sorted(want)]
            assert np.allclose([x[0] for x in got], [x[0] for x in sorted(want)], rtol=1e-6, atol=1e-5)
        if not errors:
            assert np.allclose(m.margins(binned), f, atol=1e-8)
        total = sum(g for t in trees for g, name in t if name == "x")
        assert math.isclose(m.gains()["x"], total, rel_tol=1e-6, abs_tol=1e-4)


def test_results_do_not_depend_on_the_layout_and_survive_json(spark):
    df = spark.createDataFrame(data(400, 3), COLS)
    one = [m.to_json() for m in pt.fit_many(df.repartition(1), [spec(cut=300)])]
    assert one == [m.to_json() for m in pt.fit_many(df.repartition(9), [spec(cut=300)])]
    assert pt.PoissonModel.from_json(one[0]).to_json() == one[0]


def test_unseen_keys_follow_the_default_branch(spark):
    rows = data()
    df = spark.createDataFrame(rows, COLS)
    m = pt.fit_many(df, [spec(valid=False, n_estimators=4)])[0]
    assert any(m.bins.features[f] == "station_id" for t in m.trees for f in t.feature if f >= 0)
    some = df.limit(60)
    unseen = {r.hour: r.prediction for r in m.score(some.withColumn("station_id", F.lit("never"))).collect()}
    missing = {r.hour: r.prediction for r in m.score(some.withColumn("station_id", F.lit(None).cast("string"))).collect()}
    assert unseen == missing and all(p > 0 for p in unseen.values())
    for t in m.trees:
        for i, f in enumerate(t.feature):
            if f >= 0 and m.bins.features[f] == "flag":  # no missing rows: they would go with the larger side
                assert t.missing_left[i] == (0 in t.goes_left[i])


def test_deviance_is_below_that_of_squared_loss_trees(spark):
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import GBTRegressor

    rows = [r for r in data(3000, 5) if r[1] is not None and r[2] is not None]
    df = spark.createDataFrame(rows, COLS).withColumn("k", F.ascii("station_id").cast("double"))
    train, test = df.where(F.col("hour") < F.lit(START + dt.timedelta(hours=2000))), df.where(F.col("hour") >= F.lit(START + dt.timedelta(hours=2000)))
    m = pt.fit_many(df, [pt.FitSpec("p", ("x", "station_id", "z"), {"n_estimators": 40, "num_leaves": 8, "learning_rate": 0.2}, START + dt.timedelta(hours=2000))])[0]
    # the safeguard in the hessian halves the steps, hence twice the rate of the squared-loss trees
    va = VectorAssembler(inputCols=["x", "k", "z"], outputCol="v")
    gbt = GBTRegressor(featuresCol="v", labelCol="trips", maxIter=40, maxDepth=3, seed=1).fit(va.transform(train))

    def deviance(scored):
        mu, y = F.greatest(F.col("prediction"), F.lit(1e-3)), F.col("trips").cast("double")
        return scored.agg(F.avg(2 * (F.when(y > 0, y * F.log(y / mu)).otherwise(0.0) - (y - mu)))).first()[0]

    assert deviance(m.score(test)) < deviance(gbt.transform(va.transform(test)))


def test_edge_cases(spark):
    df = spark.createDataFrame(data(300, 7), COLS)
    flat = df.withColumn("trips", F.lit(3))
    m = pt.fit_many(flat, [spec(valid=False, cut=200)])[0]
    got = m.score(flat.withColumn("prediction", F.lit("old"))).select("prediction").distinct().collect()
    assert len(got) == 1 and abs(got[0][0] - 3) < 1e-6
    with pytest.raises(ValueError, match="no training rows"):
        pt.fit_many(df, [spec(cut=-5)])
    with pytest.raises(ValueError, match="no validation rows"):
        pt.fit_many(df, [spec(cut=400)])
    assert m.score(df.limit(0)).count() == 0


def test_a_task_grows_what_the_passes_grow(spark, monkeypatch):
    df = spark.createDataFrame(data(900, 11), COLS)
    specs = [spec(cut=500, num_leaves=20, min_child_samples=3), spec("b", ("station_id", "x"), cut=550, learning_rate=0.3, n_estimators=8, valid=False),
             spec("c", n_estimators=40, learning_rate=0.8, early_stopping=2)]
    monkeypatch.setattr(pt, "_pass", None)  # no pass over the blocks is needed
    alone = [m.to_json() for m in pt.fit_many(df, specs)]
    monkeypatch.undo()
    monkeypatch.setattr(pt, "LOCAL_CELLS", 0)
    assert [m.to_json() for m in pt.fit_many(df, specs)] == alone


def test_sums_of_bundles_are_the_sums_of_the_rows(monkeypatch):
    rng = np.random.default_rng(4)
    sizes = (3, 8, 2, 65, 9)
    bins = np.stack([rng.integers(0, s, 5000).astype(np.uint16) for s in sizes])
    bins[4] = bins[1] // 2  # follows from another feature
    layout = pt.Layout(sizes, (False,) * 5)
    weights = [np.rint(rng.normal(size=5000) * 2 ** 20), np.rint(rng.random(5000) * 2 ** 45)]
    for bundle in (1, 30, 4096):
        monkeypatch.setattr(pt, "BUNDLE", bundle)
        rows = pt._Rows(bins, [0, 1, 3, 4], layout)
        assert len(rows.bundles) == {1: 4, 30: 2, 4096: 1}[bundle]
        for at in (np.arange(5000), np.sort(rng.permutation(5000)[:4800]), np.arange(0, 5000, 100)):
            want = np.zeros((sum(sizes), 3), np.int64)
            for f in (0, 1, 3, 4):
                cell = layout.offsets[f] + bins[f, at].astype(int)
                for k, w in enumerate([*weights, np.ones(5000)]):
                    np.add.at(want[:, k], cell, w[at].astype(np.int64))
            for few in (0, 10_000):
                rows.small = few
                assert np.array_equal(rows.sums(at, weights, 70), want)


def test_passes_leave_no_superseded_blocks(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(pt, "LOCAL_CELLS", 0)
    stored, gone, real = [], [], pt.materialize

    def kept(df, mode):
        stored.append(real(df, mode))
        return stored[-1]
    monkeypatch.setattr(pt, "materialize", kept)
    discard = pt.discard
    monkeypatch.setattr(pt, "discard", lambda df: (gone.append(df.inputFiles()[0].removeprefix("file:")), discard(df)))
    model = pt.fit_many(spark.createDataFrame(data(300, 2), COLS), [spec(cut=250, valid=False, n_estimators=9, num_leaves=3)])[0]
    assert len(model.trees) == 9 and len(stored) == len(gone) == 3 and not any(os.path.exists(f) for f in gone)
