"""Benchmark: headline queries on $BENCH_SF_DIR (default /root/testdata/sf0.1)
with local[$BENCH_CPUS]. Each query starts from the raw Parquet tables (the
per-session data-product cache is cleared before every query) and is executed
in full through the ``noop`` sink. Prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "naive_mae_by_hour",     # events -> clean -> dense grid -> lags -> naive MAE
    "feature_table",         # full hourly feature table (calendar, covariates, coordinates, lags)
    "station_master",
    "trim_to_lifetime",      # day-grain grid on orders x lineitem
    "backtest_summary",      # rolling-origin backtest, two baselines, 4 windows
    "error_by_series",
    "peak_bias",
    "hourly_profile",
    "cum_share_rank",
    "near_pairs",            # binned distance join
    "flatten_mapping",
    "station_profiles",
    "drift_statistics",
    "batch_forecast",        # two store partitions written and read back
    "replay_mae",
    "stream_hour_counts",
]


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    from tallycast.plans import pipelines
    from tallycast.plans.queries import REGISTRY
    from tallycast.session import get_spark

    spark = get_spark(f"local[{cpus}]", int(cpus) * 2, app_name="tallycast-bench")
    spark.sparkContext.setLogLevel("ERROR")
    # warm-up (JIT and codegen caches): the flagship once on the smoke data
    # folder when it exists, otherwise a trivial scan
    smoke = os.environ.get("BENCH_WARMUP_DIR", "/root/testdata/sf0.001")
    if os.path.isdir(smoke) and smoke != sf:
        REGISTRY["naive_mae_by_hour"](spark, smoke).collect()
    spark.read.parquet(f"{sf}/events.parquet").groupBy("event_type").count().collect()
    times = {}
    for n in names:
        pipelines.clear_products()
        t0 = time.time()
        df = REGISTRY[n](spark, sf)
        df.write.format("noop").mode("overwrite").save()
        times[n] = round(time.time() - t0, 3)
    total = round(sum(times.values()), 3)
    print(json.dumps({"metric": "headline_queries_total", "value": total, "unit": "sec", "queries": times,
                      "sf": os.path.basename(sf.rstrip("/")).replace("sf", ""), "cpus": int(cpus)}))
    spark.stop()


if __name__ == "__main__":
    main()
