"""CSV members of zip archives of any size, one task per member; and the writer.

A planning pass reads only an archive's end records and central directory, by
range requests (ZIP64 included), and lists the members. Members are dealt to
tasks by Spark; a task seeks to its member's local header and inflates it as a
stream, so no task ever holds an archive or a member whole. Paths may be of any
file system that pyarrow knows (local, ``file://``, HDFS, S3, GCS).
"""

from __future__ import annotations

import csv
import io
import re
import struct
import zipfile
import zlib

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .paths import matches

READ = 1 << 20        # bytes read or inflated at a time
CHUNK_ROWS = 20_000

# Record signatures and sizes of the zip format.
END, END64_AT, END64, CENTRAL, LOCAL = b"PK\x05\x06", b"PK\x06\x07", b"PK\x06\x06", b"PK\x01\x02", b"PK\x03\x04"
END_SIZE, END64_AT_SIZE, END64_SIZE, CENTRAL_SIZE, LOCAL_SIZE = 22, 20, 56, 46, 30
STORED, DEFLATED = 0, 8
MEMBER = "archive string, member string, method int, at long, packed long, size long, crc long"


def _place(path: str):
    """(file system, path within it)"""
    if ":" not in path.split("/", 1)[0]:
        return pafs.LocalFileSystem(), path
    return pafs.FileSystem.from_uri(re.sub("^file:/+", "file:///", path))


def open_archive(path: str) -> pa.NativeFile:
    fs, inner = _place(path)
    return fs.open_input_file(inner)


def _read(f: pa.NativeFile, at: int, n: int) -> bytes:
    f.seek(at)
    got = f.read(n)
    if len(got) != n:
        raise ValueError(f"the archive ends at {at + len(got)}, expected {n} bytes at {at}")
    return got


def _directory(f: pa.NativeFile, path: str) -> tuple[int, int, int]:
    """(place, bytes, entries) of the central directory."""
    size = f.size()
    tail = _read(f, max(0, size - END_SIZE - 0xFFFF), min(size, END_SIZE + 0xFFFF))
    i = tail.rfind(END)
    while i >= 0 and (i + END_SIZE > len(tail) or i + END_SIZE + struct.unpack_from("<H", tail, i + 20)[0] != len(tail)):
        i = tail.rfind(END, 0, i)  # the signature inside the comment
    if i < 0:
        raise ValueError(f"{path}: no end record, not a zip archive")
    entries, length, at = struct.unpack_from("<HII", tail, i + 10)
    if entries == 0xFFFF or length == 0xFFFFFFFF or at == 0xFFFFFFFF:
        j = i - END64_AT_SIZE
        if j < 0 or tail[j:j + 4] != END64_AT:
            raise ValueError(f"{path}: ZIP64 sizes without a ZIP64 locator")
        big = _read(f, struct.unpack_from("<Q", tail, j + 8)[0], END64_SIZE)
        if big[:4] != END64:
            raise ValueError(f"{path}: no ZIP64 end record where the locator points")
        entries, length, at = struct.unpack_from("<QQQ", big, 32)
    return at, length, entries


def _wide(extra: bytes, sizes: list[int]) -> list[int]:
    """The 32-bit sizes with those at their limit taken from the ZIP64 extra field."""
    i = 0
    while i + 4 <= len(extra):
        kind, n = struct.unpack_from("<HH", extra, i)
        if kind == 1:
            at = i + 4
            for k, v in enumerate(sizes):
                if v == 0xFFFFFFFF:
                    sizes[k] = struct.unpack_from("<Q", extra, at)[0]
                    at += 8
            break
        i += 4 + n
    return sizes


def members(path: str):
    """(name, method, place of the local header, packed size, size, crc) of every
    member; the directory is read a piece at a time."""
    with open_archive(path) as f:
        at, length, entries = _directory(f, path)
        buffer, end = b"", at + length
        for _ in range(entries):
            while len(buffer) < CENTRAL_SIZE or len(buffer) < CENTRAL_SIZE + sum(struct.unpack_from("<HHH", buffer, 28)):
                if at >= end:
                    raise ValueError(f"{path}: the central directory is cut short")
                piece = _read(f, at, min(READ, end - at))
                buffer, at = buffer + piece, at + len(piece)
            if buffer[:4] != CENTRAL:
                raise ValueError(f"{path}: broken central directory")
            flags, method = struct.unpack_from("<HH", buffer, 8)
            crc, packed, size = struct.unpack_from("<III", buffer, 16)
            n, e, c = struct.unpack_from("<HHH", buffer, 28)
            place = struct.unpack_from("<I", buffer, 42)[0]
            name = buffer[CENTRAL_SIZE:CENTRAL_SIZE + n].decode("utf-8" if flags & 0x800 else "cp437")
            size, packed, place = _wide(buffer[CENTRAL_SIZE + n:CENTRAL_SIZE + n + e], [size, packed, place])
            if flags & 1:
                raise ValueError(f"{path}:{name}: encrypted")
            buffer = buffer[CENTRAL_SIZE + n + e + c:]
            yield name, method, place, packed, size, crc


class Inflated(io.RawIOBase):
    """A member as a stream of its bytes; checks size and crc at the end."""

    def __init__(self, archive: str, member: str, method: int, at: int, packed: int, size: int, crc: int):
        if method not in (STORED, DEFLATED):
            raise ValueError(f"{archive}:{member}: compression method {method}")
        self.f, self.what = open_archive(archive), f"{archive}:{member}"
        head = _read(self.f, at, LOCAL_SIZE)
        if head[:4] != LOCAL:
            raise ValueError(f"{self.what}: no local header")
        self.at = at + LOCAL_SIZE + sum(struct.unpack_from("<HH", head, 26))
        self.left, self.size, self.crc = packed, size, crc
        self.got, self.sum, self.held = 0, 0, b""
        self.inflate = zlib.decompressobj(-15) if method == DEFLATED else None

    def readable(self) -> bool:
        return True

    def readinto(self, out) -> int:
        while not self.held:
            if self.inflate is not None and self.inflate.unconsumed_tail:
                self.held = self.inflate.decompress(self.inflate.unconsumed_tail, READ)
            elif self.left:
                piece = _read(self.f, self.at, min(READ, self.left))
                self.at, self.left = self.at + len(piece), self.left - len(piece)
                self.held = piece if self.inflate is None else self.inflate.decompress(piece, READ)
            else:
                if self.got != self.size or self.sum != self.crc:
                    raise ValueError(f"{self.what}: {self.got} bytes with crc {self.sum:08x}, expected {self.size} with {self.crc:08x}")
                return 0
        n = min(len(out), len(self.held))
        out[:n] = self.held[:n]
        self.sum, self.got = zlib.crc32(self.held[:n], self.sum), self.got + n
        self.held = self.held[n:]
        return n

    def close(self) -> None:
        self.f.close()
        super().close()


def list_members(spark: SparkSession, path: str, glob: str = "*.zip") -> DataFrame:
    """Root-level ``*.csv`` members of all archives of a folder; an archive without one is an error."""
    archives = sorted(matches(spark, f"{path.rstrip('/')}/{glob}"))
    if not archives:
        return spark.createDataFrame([], MEMBER)

    def run(batches):
        for b in batches:
            for archive in b.column(0).to_pylist():
                rows = [(archive, *m) for m in members(archive) if m[0].endswith(".csv") and "/" not in m[0]]
                if not rows:
                    raise ValueError(f"{archive}: no root-level CSV member")
                cols = zip(*rows)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.string(), pa.string(), pa.int32(), *[pa.int64()] * 4))],
                                                 ["archive", "member", "method", "at", "packed", "size", "crc"])

    files = spark.createDataFrame([(a,) for a in archives], "archive string")
    return files.repartition(min(len(archives), 1000)).mapInArrow(run, MEMBER)


def read_members(found: DataFrame, columns: list[str], check) -> DataFrame:
    """Rows of the listed members as strings; ``check(header, columns, what)``
    must accept every header. Each member is one task's work."""
    n = found.count()

    def run(batches):
        for b in batches:
            for m in b.to_pylist():
                raw = Inflated(m["archive"], m["member"], m["method"], m["at"], m["packed"], m["size"], m["crc"])
                with io.TextIOWrapper(io.BufferedReader(raw, READ), encoding="utf-8-sig", newline="") as text:
                    rows = csv.reader(text)
                    check(next(rows, []), columns, f"{m['archive']}:{m['member']}")
                    held = []
                    for row in rows:
                        if not row:
                            continue
                        if len(row) != len(columns):
                            raise ValueError(f"{m['archive']}:{m['member']}: {len(row)} fields in line {rows.line_num}, expected {len(columns)}")
                        held.append(row)
                        if len(held) == CHUNK_ROWS:
                            yield _batch(held, columns)
                            held = []
                    if held:
                        yield _batch(held, columns)

    # large members first: one bucket per member, so that none waits behind another
    dealt = found.repartitionByRange(max(1, n), F.desc("size"), "archive", "member")
    return dealt.mapInArrow(run, ", ".join(f"{c} string" for c in columns))


def _batch(rows: list[list[str]], columns: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*rows)], columns)


def write_archives(rows: DataFrame, folder: str, name: str, member_rows: int = 1_000_000) -> int:
    """Writes string columns as zipped CSV members, one archive per Spark
    partition that has rows, named ``<name>-<partition>.zip``; a member is closed
    after ``member_rows`` rows, nulls are empty fields. A task that runs again
    writes the same archive again. Returns the number of archives."""
    columns = rows.columns

    def run(batches):
        fs, inner = _place(folder)
        fs.create_dir(inner, recursive=True)
        archive, member, written = None, None, 0
        out = TaskContext.get().partitionId()
        for b in batches:
            for i in range(0, b.num_rows, CHUNK_ROWS):
                if archive is None:
                    sink = fs.open_output_stream(f"{inner}/{name}-{out:05d}.zip")
                    archive = zipfile.ZipFile(sink, "w", zipfile.ZIP_DEFLATED)
                if member is None or written >= member_rows:
                    if member:
                        member.close()
                    member, written = archive.open(f"{name}-{out:05d}-{len(archive.filelist):05d}.csv", "w", force_zip64=True), 0
                    member.write((",".join(columns) + "\n").encode())
                text = io.StringIO()
                part = b.slice(i, CHUNK_ROWS)
                csv.writer(text, lineterminator="\n").writerows(zip(*(c.to_pylist() for c in part.columns)))
                member.write(text.getvalue().encode())
                written += part.num_rows
        if archive:
            member.close()
            archive.close()
            sink.close()
            yield pa.RecordBatch.from_arrays([pa.array([1], pa.int64())], ["n"])

    return rows.mapInArrow(run, "n long").agg(F.sum("n")).first()[0] or 0
