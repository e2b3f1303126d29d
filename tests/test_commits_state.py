import datetime as dt
import threading

import pytest
from pyspark.sql import functions as F

from tallycast.config import DAILY, DEFAULT, HOUR
from tallycast.operators import forecast as fc
from tallycast.operators import promote
from tallycast.operators import serving_state as st
from tallycast.sources import commits

DAY = dt.date(2025, 1, 1)


def preds(spark, value, key="A"):
    return spark.createDataFrame([(key, dt.datetime(2025, 1, 2), value)], "station_id string, hour timestamp_ntz, prediction double")


def test_one_of_many_writers_wins_a_number(spark, tmp_path):
    won = []
    threads = [threading.Thread(target=lambda i=i: won.append((i, commits.commit(spark, f"{tmp_path}/c", 1, {"writer": i})))) for i in range(8)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    winners = [i for i, ok in won if ok]
    assert len(winners) == 1 and commits.records(spark, f"{tmp_path}/c") == [(1, {"writer": winners[0]})]
    assert commits.commit(spark, f"{tmp_path}/c", 2, {"writer": 9}) and not commits.commit(spark, f"{tmp_path}/c", 2, {"writer": 10})
    assert commits.records(spark, f"{tmp_path}/none") == []


def test_an_aborted_writer_leaves_nothing_visible(spark, tmp_path):
    path = f"{tmp_path}/store"
    out = preds(spark, 9.0).select(F.lit(DAY).alias("as_of"), "station_id", "hour", "prediction", F.lit("v0").alias("model_version"), F.lit("t").alias("created_at"))
    fc.stage_forecasts(out, path)  # dies before its commit
    with pytest.raises(ValueError, match="no forecast partitions"):
        fc.read_store(spark, path)
    assert fc.write_partition(preds(spark, 1.0), path, DAY, "v1") == "written"
    (tmp_path / "store" / "data" / "attempt=half" / f"as_of={DAY}").mkdir(parents=True)
    (tmp_path / "store" / "data" / "attempt=half" / f"as_of={DAY}" / "part-0.parquet").write_bytes(b"half a file")
    assert [r.prediction for r in fc.read_store(spark, path).collect()] == [1.0]


def test_of_concurrent_writers_the_second_learns_it(spark, tmp_path):
    path = f"{tmp_path}/store"

    def staged(value, version):
        return fc.stage_forecasts(preds(spark, value).select(F.lit(DAY).alias("as_of"), "station_id", "hour", "prediction", F.lit(version).alias("model_version"),
                                                             F.lit("t").alias("created_at")), path)
    first, same, other = staged(1.0, "v1"), staged(2.0, "v1"), staged(3.0, "v2")
    # all three saw an empty store
    assert fc.commit_forecast(spark, path, DAY, first, "v1", 0) == "written"
    assert fc.commit_forecast(spark, path, DAY, same, "v1", 0) == "skipped"
    with pytest.raises(ValueError, match="belongs to model version"):
        fc.commit_forecast(spark, path, DAY, other, "v2", 0)
    assert [r.prediction for r in fc.read_store(spark, path).collect()] == [1.0]
    assert fc.commit_forecast(spark, path, DAY, other, "v2", 0, force=True) == "written"
    assert [(r.prediction, r.model_version) for r in fc.read_store(spark, path).collect()] == [(3.0, "v2")]


def test_lookups_and_replay_summary(spark, tmp_path):
    path = f"{tmp_path}/store"
    fc.write_partition(preds(spark, 1.234), path, DAY, "v1")
    store = fc.read_store(spark, path)
    assert fc.forecast_lookup(store, "A").first().prediction == 1.23
    for key, day in (("B", None), ("A", dt.date(2030, 1, 1))):
        with pytest.raises(ValueError, match="no forecast of"):
            fc.forecast_lookup(store, key, day)
    daily = spark.createDataFrame([(1.0, 10), (3.0, 5)], "mae double, n long")
    assert tuple(fc.replay_summary(daily, 2.5).first()) == (2, 15, 2.0, 2.5, -0.5)


def test_two_promotions_cannot_both_decide(spark, tmp_path):
    reg = f"{tmp_path}/registry"
    decision = spark.createDataFrame([("promoted", True, "2025-04")], "status string, promoted boolean, eval_month string")
    kept = spark.createDataFrame([("kept", False, "2025-04")], decision.schema)
    assert promote.current_model(spark, reg).collect() == []
    promote.record_decision(decision, reg, "v2", "m/v2", after=0)
    with pytest.raises(promote.StaleDecision):
        promote.record_decision(decision, reg, "v3", "m/v3", after=0)  # read the registry before v2 was promoted
    promote.record_decision(kept, reg)
    assert [(n, d["status"]) for n, d in promote.decisions(spark, reg)] == [(1, "promoted"), (2, "kept")]
    assert tuple(promote.current_model(spark, reg).first()) == (1, "v2", "m/v2", "2025-04")


def grid(spark, keys, days, unit="hour", start=dt.datetime(2025, 1, 1)):
    step = dt.timedelta(hours=1) if unit == "hour" else dt.timedelta(days=1)
    n = days * 24 if unit == "hour" else days
    rows = [(k, start + step * i, (i * (j + 3) * 7919) % 23) for j, k in enumerate(keys) for i in range(n)]
    return spark.createDataFrame(rows, "station_id string, hour timestamp_ntz, trips int")


@pytest.mark.parametrize("cfg, days", [(DEFAULT, 33), (DAILY, 63)])
def test_state_features_equal_those_from_the_history(spark, tmp_path, cfg, days):
    g = grid(spark, "AB", days, cfg.grain.unit).persist()
    start, path = dt.date(2025, 1, 1) + dt.timedelta(days=days - 4), f"{tmp_path}/state"
    assert st.commit_state(st.initial_state(g, start, cfg.grain), path, start) == "written"
    for k in range(4):
        day, state = st.read_state(spark, path)
        assert day == start + dt.timedelta(days=k)
        want = fc.build_inference_features(g, None, None, day, cfg)
        got = st.state_features(state, day, cfg).select(want.columns)
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect())) and got.count() == 2 * cfg.grain.horizon
        if k < 3:
            nxt = day + dt.timedelta(days=1)
            # only the new day is offered
            new = g.where(F.to_date("hour") == F.lit(nxt))
            moved = st.advance(state, new, nxt, cfg.grain)
            assert st.commit_state(moved, path, nxt) == "written" and st.commit_state(moved, path, nxt) == "skipped"
    g.unpersist()


def test_state_refuses_gaps(spark):
    g = grid(spark, "AB", 31)
    day = dt.date(2025, 1, 30)
    state = st.initial_state(g, day, HOUR)
    with pytest.raises(ValueError, match="do not follow the state"):
        st.advance(state, g.where("hour != '2025-01-31 05:00:00' or station_id = 'A'"), dt.date(2025, 1, 31), HOUR)
    with pytest.raises(ValueError, match="do not follow the state"):
        st.advance(state, g, day, HOUR)  # the same day again
    with pytest.raises(ValueError, match="incomplete"):
        st.initial_state(g.where("hour != '2025-01-20 05:00:00'"), day, HOUR)
    stranger = g.where("station_id = 'A'").withColumn("station_id", F.lit("new"))
    assert st.advance(state, g.unionByName(stranger), dt.date(2025, 1, 31), HOUR).where("station_id = 'new'").count() == 0
