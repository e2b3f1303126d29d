import tracemalloc
import zipfile

import pytest
from pyspark.sql import functions as F

from tallycast.schemas import TRIP_COLUMNS, check_columns
from tallycast.sources import archives

HEAD = ",".join(TRIP_COLUMNS)


def line(i):
    return f"r{i},classic,2025-06-01 08:00:00.{i % 1000:03d},2025-06-01 08:20:00,\"A, b\",{i % 7},NULL,,41.9,-87.6,41.8,-87.5,member"


def test_directory_and_streams_agree_with_zipfile(tmp_path):
    path = str(tmp_path / "a.zip")
    data = {"one.csv": b"x" * 3_000_000, "sub/two.csv": bytes(range(256)) * 9000, "empty.csv": b"", "ümlaut.csv": b"hi"}
    with zipfile.ZipFile(path, "w") as zf:
        zf.comment = b"comment with PK\x05\x06 inside"
        for i, (name, body) in enumerate(data.items()):
            with zf.open(zipfile.ZipInfo(name), "w", force_zip64=bool(i % 2)) as m:
                m.write(body)
        zf.writestr(zipfile.ZipInfo("packed.csv"), b"abc" * 500_000, zipfile.ZIP_DEFLATED)
    data["packed.csv"] = b"abc" * 500_000
    got = {m[0]: m for m in archives.members(path)}
    assert list(got) == list(data)
    for name, body in data.items():
        assert archives.Inflated(path, *got[name]).read() == body
    wrong = (*got["packed.csv"][:5], 123)
    with pytest.raises(ValueError, match="crc"):
        archives.Inflated(path, *wrong).read()
    (tmp_path / "no.zip").write_bytes(b"not a zip" * 10)
    with pytest.raises(ValueError, match="no end record"):
        list(archives.members(str(tmp_path / "no.zip")))


def test_zip64_sizes_are_followed(tmp_path, monkeypatch):
    # a small archive whose directory is written as those of archives above 4 GB are
    monkeypatch.setattr(zipfile, "ZIP64_LIMIT", 100)
    path = str(tmp_path / "big.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED, allowZip64=True) as zf:
        for i in range(5):
            zf.writestr(f"m{i}.csv", (f"{i}" * 50_000).encode())
    raw = open(path, "rb").read()
    assert archives.END64 in raw
    for name, *rest in archives.members(path):
        assert archives.Inflated(path, name, *rest).read() == name[1].encode() * 50_000


def test_a_large_member_streams_in_bounded_memory(tmp_path):
    path = str(tmp_path / "202506-large.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as zf, zf.open("trips.csv", "w") as m:
        block = b"0123456789abcdef" * 65536
        for _ in range(96):
            m.write(block)
    (name, *rest), = archives.members(path)
    tracemalloc.start()
    raw, n = archives.Inflated(path, name, *rest), 0
    while piece := raw.read(1 << 16):
        n += len(piece)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert n == 96 << 20 and peak < 8 << 20


def test_members_of_several_archives_are_read_by_tasks_of_their_own(spark, tmp_path):
    want = 0
    for k in range(3):
        with zipfile.ZipFile(tmp_path / f"20250{k + 1}-t.zip", "w", zipfile.ZIP_DEFLATED) as zf:
            for j in range(k + 1):
                n = 50 * (j + 1)
                zf.writestr(f"part{j}.csv", "\n".join([HEAD, *map(line, range(n))]) + "\n")
                want += n
            zf.writestr("__MACOSX/part0.csv", "junk")
    found = archives.list_members(spark, str(tmp_path))
    assert found.count() == 6
    df = archives.read_members(found, TRIP_COLUMNS, check_columns)
    assert df.count() == want and df.select(F.spark_partition_id()).distinct().count() > 3
    assert df.where("start_station_name = 'A, b' AND end_station_name = 'NULL' AND end_station_id = ''").count() == want
    with zipfile.ZipFile(tmp_path / "202509-t.zip", "w") as zf:
        zf.writestr("x.csv", f"{HEAD}\n1,2\n")
    with pytest.raises(Exception, match="2 fields in line 2"):
        archives.read_members(archives.list_members(spark, str(tmp_path), "202509*"), TRIP_COLUMNS, check_columns).collect()


def test_archives_written_by_tasks_come_back(spark, tmp_path):
    df = spark.range(500).select(F.col("id").cast("string").alias("a"), F.when(F.col("id") % 3 > 0, F.lit('q"uo,te\nd')).alias("b")).repartition(3)
    assert archives.write_archives(df, str(tmp_path / "z"), "202501-x", 100) == 3
    found = archives.list_members(spark, str(tmp_path / "z"))
    got = archives.read_members(found, ["a", "b"], check_columns).collect()
    assert sorted((int(r.a), r.b) for r in got) == [(i, 'q"uo,te\nd' if i % 3 else "") for i in range(500)]
    assert archives.list_members(spark, str(tmp_path / "none")).count() == 0
