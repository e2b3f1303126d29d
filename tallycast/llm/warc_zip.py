"""Web archives packaged as ZIP files: writer, and a reader by byte ranges.

A package holds one stored (uncompressed) member of WARC records, each its own
gzip member, and one stored index with the place of every record. The reader
never extracts: it takes the end-of-directory record from the file's tail
(with the ZIP64 locator and record where there are any), the central directory,
a member's local header, and then just the ranges of the index and of the
records, near ones in one request.

Packages are written by tasks, under names of their own attempt, to the
shared folder; the table of packages lists only what finished tasks wrote, so
lost executors and repeated attempts leave nothing behind that is read. A
package is closed at ``PACKAGE_BYTES``; memory holds one record and the index.
"""

from __future__ import annotations

import base64
import hashlib
import json
import re
import struct
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .common import shared_path, stored

PACKAGE_BYTES = 64 << 20
READ_BYTES = 4 << 20
DATA_MEMBER, INDEX_MEMBER = "archive/data.warc.gz", "indexes/index.cdxj"
PAGE_URN = "urn:x-page:"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

# Fixed values of the ZIP format.
LOCAL, CENTRAL, END, END64, LOCATOR64, DESCRIPTOR = (b"PK\3\4", b"PK\1\2", b"PK\5\6", b"PK\6\6", b"PK\6\7", b"PK\7\x08")
MAX16, MAX32 = 0xFFFF, 0xFFFFFFFF


def open_store(uri: str):
    """(file system, path) of a URI; works for every store that pyarrow knows."""
    from pyarrow import fs

    uri = re.sub(r"^file:/+", "file:///", uri)
    return fs.FileSystem.from_uri(uri if "://" in uri else f"file://{uri}")


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _header_value(text: str) -> str:
    """One header line's value: control characters are percent-encoded."""
    return re.sub(r"[\x00-\x1f\x7f]", lambda m: f"%{ord(m.group()):02X}", text)


def warc_record(page_id, url, payload: bytes, digest: str, refers_to, is_revisit: bool, name: str) -> bytes:
    """One uncompressed WARC record. A revisit keeps the HTTP head, with the
    full payload's length, and leaves out the payload."""
    http = (b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload))
    block = http if is_revisit else http + payload
    lines = ["WARC/1.1", f"WARC-Type: {'revisit' if is_revisit else 'response'}", f"WARC-Record-ID: <{name}>",
             "WARC-Date: 1970-01-01T00:00:00Z", f"WARC-Payload-Digest: sha1:{digest}"]
    if url is not None:
        lines.append(f"WARC-Target-URI: {_header_value(url)}")
    if is_revisit:
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <{PAGE_URN}{refers_to}>"]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(lines).encode() + block + b"\r\n\r\n"


class PackageWriter:
    """Streams stored members into a ZIP file; sizes follow the data (descriptors),
    so nothing is rewound. ZIP64 fields are written where a number needs them, or always."""

    def __init__(self, out, zip64: bool = False):
        self.out, self.at, self.entries, self.zip64 = out, 0, [], zip64

    def _put(self, data: bytes) -> None:
        self.out.write(data)
        self.at += len(data)

    def begin(self, name: str) -> None:
        raw = name.encode()
        self.entries.append([raw, self.at, 0, 0])
        self._put(LOCAL + struct.pack("<5H3I2H", 45, 0x0808, 0, 0, 0x21, 0, 0, 0, len(raw), 0) + raw)

    def add(self, data: bytes) -> int:
        """Appends to the open member; returns where, from the member's start."""
        e = self.entries[-1]
        where, e[2], e[3] = e[3], zlib.crc32(data, e[2]), e[3] + len(data)
        self._put(data)
        return where

    def end(self) -> None:
        _, _, crc, size = self.entries[-1]
        wide = self.zip64 or size > MAX32
        self._put(DESCRIPTOR + struct.pack("<IQQ" if wide else "<III", crc, size, size))

    def close(self) -> None:
        start = self.at
        for raw, offset, crc, size in self.entries:
            wide = self.zip64 or max(size, offset) >= MAX32
            extra = struct.pack("<HHQQQ", 1, 24, size, size, offset) if wide else b""
            small, place = (MAX32, MAX32) if wide else (size, offset)
            self._put(CENTRAL + struct.pack("<6H3I5H2I", 45, 45, 0x0808, 0, 0, 0x21, crc, small, small, len(raw), len(extra), 0, 0, 0, 0, place) + raw + extra)
        size, n = self.at - start, len(self.entries)
        if self.zip64 or start >= MAX32 or size >= MAX32 or n >= MAX16:
            end64 = self.at
            self._put(END64 + struct.pack("<Q2H2I4Q", 44, 45, 45, 0, 0, n, n, size, start))
            self._put(LOCATOR64 + struct.pack("<IQI", 0, end64, 1))
            n, size, start = MAX16, MAX32, MAX32
        self._put(END + struct.pack("<4H2IH", 0, 0, n, n, size, start, 0))


def _end_of_directory(f, length: int) -> tuple[int, int, int]:
    """(entries, size, offset) of the central directory."""
    tail_at = max(0, length - 22 - MAX16)
    tail = f.read_at(length - tail_at, tail_at)
    at = tail.rfind(END)
    while at >= 0:  # the signature may also occur in the comment
        if at + 22 <= len(tail) and at + 22 + struct.unpack_from("<H", tail, at + 20)[0] == len(tail):
            break
        at = tail.rfind(END, 0, at)
    if at < 0:
        raise ValueError("no end-of-directory record: not a ZIP package")
    n, size, offset = struct.unpack_from("<H2I", tail, at + 10)
    where = tail_at + at
    if (n == MAX16 or size == MAX32 or offset == MAX32) and where >= 20:
        locator = f.read_at(20, where - 20)
        if locator[:4] == LOCATOR64:
            record = f.read_at(56, struct.unpack_from("<Q", locator, 8)[0])
            if record[:4] != END64:
                raise ValueError("the ZIP64 locator points at no end record")
            n, size, offset = struct.unpack_from("<3Q", record, 32)
    return n, size, offset


def members(f, length: int) -> dict[str, tuple[int, int, int]]:
    """name -> (offset of the local header, size, method), from the central directories."""
    n, size, offset = _end_of_directory(f, length)
    raw, at, out = f.read_at(size, offset), 0, {}
    for _ in range(n):
        if raw[at:at + 4] != CENTRAL:
            raise ValueError("damaged central directory")
        method = struct.unpack_from("<H", raw, at + 10)[0]
        packed, full, n_name, n_extra, n_comment = struct.unpack_from("<2I3H", raw, at + 20)
        header = struct.unpack_from("<I", raw, at + 42)[0]
        name = raw[at + 46:at + 46 + n_name].decode("utf-8", "replace")
        extra, x = raw[at + 46 + n_name:at + 46 + n_name + n_extra], 0
        while x + 4 <= len(extra):
            kind, n_data = struct.unpack_from("<HH", extra, x)
            if kind == 1:  # wide numbers, only those whose short field is full
                y = x + 4
                if full == MAX32:
                    full, y = struct.unpack_from("<Q", extra, y)[0], y + 8
                if packed == MAX32:
                    packed, y = struct.unpack_from("<Q", extra, y)[0], y + 8
                if header == MAX32:
                    header = struct.unpack_from("<Q", extra, y)[0]
            x += 4 + n_data
        out[name] = (header, packed, method)
        at += 46 + n_name + n_extra + n_comment
    return out


def member_range(f, name: str, entry: tuple[int, int, int]) -> tuple[int, int]:
    """(first byte, size) of a stored member's data."""
    header, size, method = entry
    if method != 0:
        raise ValueError(f"{name} is compressed in its package; only stored members can be read by range")
    local = f.read_at(30, header)
    if local[:4] != LOCAL:
        raise ValueError(f"no local header for {name}")
    n_name, n_extra = struct.unpack_from("<2H", local, 26)
    return header + 30 + n_name + n_extra, size


def _indexed(lines: list[bytes]) -> Iterator[list[tuple[int, int]]]:
    """Runs of adjacent records, up to READ_BYTES together."""
    run: list[tuple[int, int]] = []
    for line in lines:
        entry = json.loads(line)
        at, n = entry["offset"], entry["length"]
        if run and (at != run[-1][0] + run[-1][1] or at + n - run[0][0] > READ_BYTES):
            yield run
            run = []
        run.append((at, n))
    if run:
        yield run


def _unindexed(f, first: int, size: int) -> Iterator[tuple[int, bytes]]:
    """Records of a member without an index: its gzip members one after the other."""
    at, rest = 0, b""
    gz, start, parts = zlib.decompressobj(31), 0, []
    while at < size or rest:
        if not rest:
            rest = f.read_at(min(READ_BYTES, size - at), first + at)
            at += len(rest)
        parts.append(gz.decompress(rest))
        rest = gz.unused_data
        if gz.eof:
            yield start, b"".join(parts)
            start, gz, parts = at - len(rest), zlib.decompressobj(31), []


def read_package(uri: str) -> Iterator[tuple[str, int, bytes]]:
    """(member, offset, record) of every record of a package."""
    store, path = open_store(uri)
    with store.open_input_file(path) as f:
        found = members(f, f.size())
        archives = sorted(n for n in found if n.startswith("archive/"))
        index = sorted(n for n in found if n.startswith("indexes/"))
        if index and len(archives) == 1:
            first, size = member_range(f, archives[0], found[archives[0]])
            for name in index:
                a, n = member_range(f, name, found[name])
                for run in _indexed(f.read_at(n, a).splitlines()):
                    start = run[0][0]
                    data = f.read_at(run[-1][0] + run[-1][1] - start, first + start)
                    for at, length in run:
                        yield archives[0], at, zlib.decompress(data[at - start:at - start + length], 31)
        else:
            for name in archives:
                first, size = member_range(f, name, found[name])
                for at, record in _unindexed(f, first, size):
                    yield name, at, record


def parse_record(record: bytes) -> dict:
    """Headers and payload of one record: page_id, url, record_type, payload
    (None for a revisit), payload_bytes, payload_digest, refers_to."""
    head, _, rest = record.partition(b"\r\n\r\n")
    fields = {k.lower(): v for k, _, v in (line.partition(": ") for line in head.decode().split("\r\n")[1:])}
    block = rest[:int(fields["content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    full = int(re.search(rb"(?i)content-length: (\d+)", http).group(1))
    page = lambda v: int(v[len(PAGE_URN) + 1:-1]) if v and re.fullmatch(rf"<{PAGE_URN}-?\d+>", v) else None
    revisit = fields["warc-type"] == "revisit"
    return {"page_id": page(fields.get("warc-record-id")), "url": fields.get("warc-target-uri"), "record_type": fields["warc-type"],
            "payload": None if revisit else payload, "payload_bytes": full,
            "payload_digest": fields["warc-payload-digest"].removeprefix("sha1:") if revisit else base32_sha1(payload),
            "refers_to": page(fields.get("warc-refers-to"))}


def revisits(pages: DataFrame, payload: Column, min_bytes: int = 0) -> DataFrame:
    """(page_id, digest, refers_to) of the records that repeat another's payload
    of at least ``min_bytes``: all but those with the smallest id of the payload.
    Only ids and digests are shuffled; the first ids are partial minima, so a
    payload that a third of the pages share is not gathered."""
    ids = pages.select("page_id", F.sha1(payload).alias("digest"), F.octet_length(payload).alias("n")).filter(F.col("n") >= min_bytes).distinct()
    first = ids.groupBy("digest").agg(F.min("page_id").alias("refers_to"), F.count("*").alias("n")).filter("n > 1 and refers_to is not null")
    return ids.join(first.select("digest", "refers_to"), "digest").filter("page_id != refers_to").select("page_id", "digest", "refers_to")


def write_packages(pages: DataFrame, folder: str, min_bytes: int = 0, package_bytes: int = PACKAGE_BYTES, zip64: bool = False) -> DataFrame:
    """Writes a record per row of ``pages`` (page_id, url, html) and returns the
    table of packages (uri, records, bytes), materialised once.

    A null html is an empty payload. A page without an id gets a record that
    refers to nothing; rows that repeat the id of a payload's response are
    responses, too. Other columns are ignored; no page, no package.
    """
    payload = F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary")
    src = pages.select("page_id", F.col("url").cast("string").alias("url"), F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"),
                       F.sha1(payload).alias("digest"))
    again = revisits(pages, payload, min_bytes).select(F.col("page_id").alias("_p"), F.col("digest").alias("_d"), "refers_to")
    rows = (src.join(again, (F.col("page_id") == F.col("_p")) & (F.col("digest") == F.col("_d")), "left")
            .select("page_id", "url", "html", "digest", "refers_to"))

    def run(batches):
        from pyspark import TaskContext

        ctx = TaskContext.get()
        store, base = open_store(folder)
        store.create_dir(base, recursive=True)
        done, state = [], None

        def finish():
            out, w, index, name = state
            w.end()
            w.begin(INDEX_MEMBER)
            w.add(b"".join(index))
            w.end()
            w.close()
            out.close()
            done.append((f"{folder}/{name}", len(index), w.at))

        seq = 0
        for b in batches:
            ids, urls, digests, refers = (b.column(i).to_pylist() for i in (0, 1, 3, 4))
            for i in range(b.num_rows):
                if state is None:
                    name = f"pages-{ctx.partitionId():06d}-{ctx.taskAttemptId()}-{uuid.uuid4().hex}.zip"
                    out = store.open_output_stream(f"{base}/{name}")
                    w = PackageWriter(out, zip64)
                    w.begin(DATA_MEMBER)
                    state = (out, w, [], name)
                w, index = state[1], state[2]
                body = b.column(2)[i].as_py().encode()
                digest = base64.b32encode(bytes.fromhex(digests[i])).decode()
                seq += 1
                own = f"{PAGE_URN}{ids[i]}" if ids[i] is not None else f"urn:x-record:{ctx.partitionId()}:{seq}"
                record = warc_record(ids[i], urls[i], body, digest, refers[i], refers[i] is not None, own)
                gz = zlib.compressobj(1, zlib.DEFLATED, 31)
                data = gz.compress(record) + gz.flush()
                at = w.add(data)
                index.append((json.dumps({"id": own, "digest": f"sha1:{digest}", "offset": at, "length": len(data)}) + "\n").encode())
                if w.at >= package_bytes:
                    finish()
                    state = None
        if state is not None:
            finish()
        yield pa.RecordBatch.from_pylist([dict(zip(("uri", "records", "bytes"), d)) for d in done],
                                         pa.schema([("uri", pa.string()), ("records", pa.int64()), ("bytes", pa.int64())]))

    return stored(rows.mapInArrow(run, "uri string, records long, bytes long"), "warc-packages")


def read_packages(packages: DataFrame, with_payload: bool = True) -> DataFrame:
    """Every record of the packages listed in ``packages.uri``: page_id, url,
    record_type, payload, payload_bytes, payload_digest (bare upper-case base32,
    computed from a response's payload), refers_to, package, offset."""
    fields = {"page_id": pa.int64(), "url": pa.string(), "record_type": pa.string(), "payload": pa.binary(), "payload_bytes": pa.int64(),
              "payload_digest": pa.string(), "refers_to": pa.int64(), "package": pa.string(), "offset": pa.int64()}
    if not with_payload:
        del fields["payload"]
    schema = pa.schema(list(fields.items()))

    def run(batches):
        for b in batches:
            for uri in b.column(0).to_pylist():
                held, size = [], 0
                for _, at, record in read_package(uri):
                    row = parse_record(record) | {"package": uri, "offset": at}
                    held.append({k: row[k] for k in fields})
                    size += len(record) if with_payload else 200
                    if size > READ_BYTES:
                        yield pa.RecordBatch.from_pylist(held, schema)
                        held, size = [], 0
                if held:
                    yield pa.RecordBatch.from_pylist(held, schema)

    kinds = {pa.int64(): "bigint", pa.string(): "string", pa.binary(): "binary"}
    ddl = ", ".join(f"{k} {kinds[v]}" for k, v in fields.items())
    n = max(1, min(packages.count(), 100_000))  # a task per package
    return packages.select("uri").repartition(n).mapInArrow(run, StructType.fromDDL(ddl))


def archive_round_trip(spark: SparkSession, pages: DataFrame, min_bytes: int = 0, **params) -> DataFrame:
    packages = write_packages(pages, shared_path(spark, "warc"), min_bytes, **params)
    return read_packages(packages, with_payload=False)
