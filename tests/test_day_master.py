import datetime as dt

import pytest

from tallycast.operators import grid
from tallycast.plans import pipelines
from tallycast.plans.pipelines import DAY_CFG

START = dt.datetime(1995, 1, 1)


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """More suppliers than the scope holds; orders without line items and suppliers without names do not matter."""
    at, n = str(tmp_path_factory.mktemp("orders")), DAY_CFG.top_n + 7
    orders = [(o, START + dt.timedelta(days=o % 40), "1-URGENT") for o in range(120)]
    items = [(s % 110 + k, k, s, START + dt.timedelta(days=(s % 110 + k) % 40 + 3 + k), "R", float(s % 9 + k), 0.01 * k, 0.02, 100.0 + s)
             for s in range(n) for k in range(1, 3 + (s >= 7))]
    spark.createDataFrame(orders, "o_orderkey long, o_orderdate timestamp_ntz, o_orderpriority string").write.parquet(f"{at}/orders.parquet")
    spark.createDataFrame(items, "l_orderkey long, l_linenumber int, l_suppkey long, l_shipdate timestamp_ntz, l_returnflag string, l_quantity double, "
                                 "l_discount double, l_tax double, l_extendedprice double").write.parquet(f"{at}/lineitem.parquet")
    yield at
    pipelines.clear_products()


def test_the_day_master_holds_the_scope_only_and_what_the_full_one_says(spark, tables):
    got = {r.station_id: r for r in pipelines.day_master(spark, tables).collect()}
    full = {r.station_id: r for r in grid.station_master(pipelines.day_clean(spark, tables), DAY_CFG).collect()}
    scope = {r.station_id for r in pipelines.day_scope(spark, tables).collect()}
    assert len(full) == DAY_CFG.top_n + 7 and len(scope) == DAY_CFG.top_n
    assert got == {k: full[k] for k in scope}
    f = pipelines.day_features(spark, tables).select("station_id", "lat", "lng").distinct().collect()
    assert {(r.station_id, r.lat, r.lng) for r in f} == {(k, full[k].lat, full[k].lng) for k in scope}


def test_line_items_out_of_scope_do_not_meet_the_orders(spark, tables):
    plan = pipelines.day_clean(spark, tables, pipelines.day_scope(spark, tables))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Join Inner") < plan.index("Join LeftSemi")
