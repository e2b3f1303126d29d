import datetime as dt
import json
import zipfile

import pytest
from pyspark.sql import functions as F

from tallycast.schemas import TRIP_COLUMNS, SchemaError, check_columns
from tallycast.sources import trips as st
from tallycast.sources import weather as sw

HEADER = ",".join(TRIP_COLUMNS)
ROWS = [
    "r1,classic_bike,2025-06-01 08:00:00,2025-06-01 08:10:00,Clark & Lake,TA1307000017,,,41.886,-87.631,41.89,-87.62,member",
    "r2,electric_bike,2025-06-01 09:00:00.123,2025-06-01 09:30:00.5,Wells St,13022,NULL,NULL,41.9,-87.63,,,casual",
]


def test_month_from_key(spark):
    df = spark.createDataFrame([("202406-city-tripdata.zip",), ("s3/x/202312-tripdata.zip",), ("notes.txt",),
                                ("2024-06-city.zip",)], "path string")
    got = [r.m for r in df.select(st.month_from_key(F.col("path")).alias("m")).collect()]
    assert got == ["2024-06", "2023-12", None, None]


def test_zip_traps(spark, tmp_path):
    z = tmp_path / "landing"
    z.mkdir()
    with zipfile.ZipFile(z / "202506-city-tripdata.zip", "w") as zf:
        zf.writestr("202506-city-tripdata.csv", HEADER + "\n" + "\n".join(ROWS) + "\n")
        zf.writestr("__MACOSX/._202506-city-tripdata.csv", "junk")
    df = st.read_trip_zips(spark, str(z)).orderBy("ride_id").collect()
    assert len(df) == 2
    assert df[1].started_at == dt.datetime(2025, 6, 1, 9, 0, 0)  # fractional seconds stripped
    assert df[1].start_station_id == "13022"  # numeric-looking id stays a string
    assert df[1].end_station_id is None and df[1].end_lat is None  # NULL token and empty field
    assert df[0].start_station_id == "TA1307000017"


def test_zip_without_root_csv_fails(spark, tmp_path):
    z = tmp_path / "bad"
    z.mkdir()
    with zipfile.ZipFile(z / "202506-x.zip", "w") as zf:
        zf.writestr("folder/inner.csv", HEADER + "\n")
    with pytest.raises(Exception, match="no root-level CSV"):
        st.read_trip_zips(spark, str(z)).collect()


def test_schema_failure_is_loud():
    with pytest.raises(SchemaError, match="missing"):
        check_columns(TRIP_COLUMNS[:-1], TRIP_COLUMNS, "trips")
    with pytest.raises(SchemaError, match="order"):
        check_columns(list(reversed(TRIP_COLUMNS)), TRIP_COLUMNS, "trips")


def test_csv_reader_and_incremental_months(spark, tmp_path):
    p = tmp_path / "csv"
    p.mkdir()
    (p / "a.csv").write_text(HEADER + "\n" + "\n".join(ROWS) + "\n")
    t = st.read_trip_csv(spark, str(p))
    assert t.count() == 2 and dict(t.dtypes)["started_at"] == "timestamp_ntz"
    store = str(tmp_path / "store")
    st.write_by_month(t, store)
    avail = spark.createDataFrame([("202505-a.zip",), ("202506-a.zip",), ("202507-a.zip",)], "path string")
    todo = st.incremental_months(st.months_in_range(avail, "2025-01", "2025-12"), st.stored_months(spark, store))
    assert [r.month for r in todo.collect()] == ["2025-05", "2025-07"]


def test_payloads_with_other_fields_or_lengths_are_refused(spark, tmp_path):
    names = ["temperature_2m", "precipitation", "snowfall", "wind_speed_10m", "relative_humidity_2m"]
    good = {"time": ["2024-02-29T00:00"], **{n: [1.0] for n in names}}
    for name, change, says in (("extra", {"pressure": [1.0]}, "extra=\\['pressure'\\]"), ("short", {"snowfall": []}, "differ in length")):
        f = tmp_path / f"{name}.json"
        f.write_text(json.dumps({"hourly": good | change}))
        with pytest.raises(Exception, match=says):
            sw.read_payloads(spark, str(f)).collect()
    missing = tmp_path / "missing.json"
    missing.write_text(json.dumps({"hourly": {k: v for k, v in good.items() if k != "snowfall"}}))
    with pytest.raises(Exception, match="missing=\\['snowfall'\\]"):
        sw.read_payloads(spark, str(missing)).collect()


def test_products_are_partitioned_by_month(spark, tmp_path):
    from tallycast.sources import sinks
    rows = [(dt.datetime(2025, m, 3), m) for m in (1, 1, 2, 3)]
    df = spark.createDataFrame(rows, "hour timestamp_ntz, v int")
    path = sinks.write_product(df, str(tmp_path), "features")
    sinks.write_product(df.where("v = 2").withColumn("v", F.lit(20)), str(tmp_path), "features")
    assert sorted(r.v for r in sinks.read_product(spark, str(tmp_path), "features").collect()) == [1, 1, 3, 20]
    one = sinks.read_product(spark, str(tmp_path), "features", ["2025-01"])
    assert one.columns == ["hour", "v"] and one.count() == 2 and sorted(p.name for p in tmp_path.joinpath("features").glob("_month=*")) == [f"_month=2025-0{m}" for m in (1, 2, 3)]
    assert "PartitionFilters: [" in one._jdf.queryExecution().executedPlan().toString() and path.endswith("/features")


def test_payload_reshaping_and_month_bounds(spark, tmp_path):
    payload = {"latitude": 41.9, "hourly": {"time": ["2024-02-29T00:00", "2024-02-29T01:00"],
                                             "temperature_2m": [1.5, 2.0], "precipitation": [0.0, 0.2],
                                             "snowfall": [0.0, 0.0], "wind_speed_10m": [3.0, 4.0],
                                             "relative_humidity_2m": [80.0, 82.0]}}
    f = tmp_path / "w.json"
    f.write_text(json.dumps(payload, indent=2))
    rows = sw.read_payloads(spark, str(f)).collect()
    assert [r.timestamp for r in rows] == [dt.datetime(2024, 2, 29, 0), dt.datetime(2024, 2, 29, 1)]
    assert rows[1].precipitation == 0.2
    m = spark.createDataFrame([("2024-02",), ("2023-02",)], "m string")
    first, last = sw.month_bounds(F.col("m"))
    got = [(r.a, r.b) for r in m.select(first.alias("a"), last.alias("b")).collect()]
    assert got == [(dt.date(2024, 2, 1), dt.date(2024, 2, 29)), (dt.date(2023, 2, 1), dt.date(2023, 2, 28))]
    bad = tmp_path / "bad.json"
    bad.write_text(json.dumps({"daily": {}}))
    with pytest.raises(ValueError, match="hourly"):
        sw.read_payloads(spark, str(bad))


def test_stream_ingestion_reads_each_file_once(spark, tmp_path):
    from tallycast.streaming.ingest import ingest_trip_files
    landing, out, ckpt = tmp_path / "landing", str(tmp_path / "out"), str(tmp_path / "ckpt")
    landing.mkdir()
    (landing / "a.csv").write_text(HEADER + "\n" + ROWS[0] + "\n")
    ingest_trip_files(spark, str(landing), out, ckpt)
    (landing / "b.csv").write_text(HEADER + "\n" + ROWS[1] + "\n")
    ingest_trip_files(spark, str(landing), out, ckpt)
    ingest_trip_files(spark, str(landing), out, ckpt)
    got = spark.read.parquet(out)
    assert sorted(r.ride_id for r in got.collect()) == ["r1", "r2"]
    assert [r.month for r in got.select("month").distinct().collect()] == ["2025-06"]
