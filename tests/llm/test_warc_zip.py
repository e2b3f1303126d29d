import base64
import gzip
import hashlib
import io
import random
import zipfile
import zlib

import pytest
from pyarrow import BufferReader

from tallycast.llm import warc_zip as Z


def slow(rows):
    first = {}
    for i, _, h in rows:
        if i is not None:
            first[h or ""] = min(i, first.get(h or "", i))
    out = []
    for i, _, h in rows:
        p = (h or "").encode()
        refers = first.get(h or "")
        again = i is not None and i != refers
        out.append((i, len(p), base64.b32encode(hashlib.sha1(p).digest()).decode(), "revisit" if again else "response", refers if again else None))
    return out


def pages(n=60):
    rng = random.Random(3)
    bodies = ["<p>%d</p>\r\n\r\nWARC/1.1 é" % i for i in range(20)] + ["", None, "PK\5\6" * 50, "x" * 200_000]
    rows = [(i * 3, rng.choice(["http://a/%d" % i, None, "http://b/\r\nWARC-Type: evil"]), rng.choice(bodies)) for i in range(n)]
    return rows + [(5000, "u", bodies[0])] * 2 + [(None, None, "own"), (-7, "u", bodies[1])]


@pytest.mark.parametrize("zip64,limit", [(False, 1 << 26), (True, 3000)])
def test_round_trip(spark, tmp_path, zip64, limit):
    rows = pages()
    df = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, offset string").repartition(3)
    packages = Z.write_packages(df, f"file:{tmp_path}/w", package_bytes=limit, zip64=zip64)
    got = Z.read_packages(packages).collect()
    key = lambda r: tuple((x is None, x) if x is not None else (True, 0) for x in r)
    assert sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got), key=key) == sorted(slow(rows), key=key)
    text = {(i, (h or "").encode()) for i, _, h in rows}
    assert all((r.page_id, bytes(r.payload)) in text for r in got if r.record_type == "response")
    assert all(r.payload is None for r in got if r.record_type == "revisit")
    # an independent reader opens the packages and finds the same members
    for p in packages.collect():
        with zipfile.ZipFile(p.uri.removeprefix("file:")) as z:
            assert z.testzip() is None and z.namelist() == [Z.DATA_MEMBER, Z.INDEX_MEMBER]
            assert all(i.compress_type == zipfile.ZIP_STORED for i in z.infolist())
            raw, n = z.read(Z.DATA_MEMBER), 0
            while raw:
                d = zlib.decompressobj(31)
                assert d.decompress(raw).startswith(b"WARC/1.1\r\n")
                raw, n = d.unused_data, n + 1
            assert n == p.records
    assert (packages.count() > 3) == (limit < 10_000)


def test_smaller_payloads_are_all_responses(spark):
    rows = [(1, "a", "tiny"), (2, "b", "tiny"), (3, "c", "long enough"), (4, "d", "long enough")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: (r.record_type, r.refers_to) for r in Z.archive_round_trip(spark, df, min_bytes=5).collect()}
    assert got == {1: ("response", None), 2: ("response", None), 3: ("response", None), 4: ("revisit", 3)}
    assert Z.archive_round_trip(spark, df.limit(0)).collect() == []


def test_foreign_packages(tmp_path):
    gz = gzip.compress
    records = [Z.warc_record(i, "u", b"body %d" % i, Z.base32_sha1(b"body %d" % i), None, False, f"{Z.PAGE_URN}{i}") for i in range(4)]
    path = tmp_path / "a.zip"
    with zipfile.ZipFile(path, "w", zipfile.ZIP_STORED) as z:
        z.writestr("archive/one.warc.gz", gz(records[0]) + gz(records[1]))
        z.writestr("archive/two.warc.gz", gz(records[2]) + gz(records[3]))
        z.writestr("readme.txt", "no archive")
        z.comment = b"note PK\5\6 " + b"\0" * 40
    assert [Z.parse_record(r)["payload"] for _, _, r in Z.read_package(str(path))] == [b"body %d" % i for i in range(4)]
    with zipfile.ZipFile(tmp_path / "b.zip", "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("archive/one.warc.gz", gz(records[0]))
    with pytest.raises(ValueError, match="compressed"):
        list(Z.read_package(str(tmp_path / "b.zip")))
    (tmp_path / "c.zip").write_bytes(b"not a package")
    with pytest.raises(ValueError, match="not a ZIP"):
        list(Z.read_package(str(tmp_path / "c.zip")))


def test_zip64_directory_is_followed():
    out = io.BytesIO()
    w = Z.PackageWriter(out, zip64=True)
    w.begin("archive/x")
    w.add(b"12345")
    w.end()
    w.close()
    f = BufferReader(out.getvalue())
    read = type("F", (), {"read_at": lambda self, n, at: f.read_at(n, at)})()
    found = Z.members(read, len(out.getvalue()))
    assert Z.member_range(read, "archive/x", found["archive/x"])[1] == 5
