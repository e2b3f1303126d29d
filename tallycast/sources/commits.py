"""Numbered commit records: small JSON files, each created only if absent.

A record is written under another name first and then given its own by one
operation that fails when the name is taken, so a reader never sees half a
record, and of two writers that want the same number one learns that it lost.
"""

from __future__ import annotations

import json
import uuid
from urllib.parse import unquote

from pyspark.sql import SparkSession

from .paths import matches


def _file_system(spark: SparkSession, folder: str):
    jvm = spark.sparkContext._jvm
    conf = spark._jsparkSession.sessionState().newHadoopConf()
    path = jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(conf)
    return jvm, conf, fs, fs.makeQualified(path)


def commit(spark: SparkSession, folder: str, number: int, record: dict) -> bool:
    """Creates record ``number``; False when another writer already has."""
    jvm, conf, fs, home = _file_system(spark, folder)
    fs.mkdirs(home)
    staged = jvm.org.apache.hadoop.fs.Path(home, f"_staged-{uuid.uuid4().hex}")
    target = jvm.org.apache.hadoop.fs.Path(home, f"{number:08d}.json")
    out = fs.create(staged, True)
    out.write(bytearray(json.dumps(record, sort_keys=True).encode()))
    out.close()
    try:
        if home.toUri().getScheme() == "file":
            # a hard link is the local operation that is both atomic and refused when the name is taken
            files, paths = jvm.java.nio.file.Files, jvm.java.nio.file.Paths
            files.createLink(paths.get(target.toUri().getPath(), _strings(spark)), paths.get(staged.toUri().getPath(), _strings(spark)))
        else:
            options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
            options[0] = jvm.org.apache.hadoop.fs.Options.Rename.NONE
            jvm.org.apache.hadoop.fs.FileContext.getFileContext(home.toUri(), conf).rename(staged, target, options)
        return True
    except Exception as e:
        if fs.exists(target):
            return False
        raise e
    finally:
        fs.delete(staged, False)


def _strings(spark: SparkSession):
    return spark.sparkContext._gateway.new_array(spark.sparkContext._jvm.java.lang.String, 0)


def records_by_folder(spark: SparkSession, pattern: str) -> dict[str, list[tuple[int, dict]]]:
    """Folder name -> its records in order of number, for all folders that a glob
    pattern matches, in one read. They are as many as there were commits; the
    driver holds them."""
    names = [p for p in matches(spark, f"{pattern}/*.json") if not p.rsplit("/", 1)[-1].startswith("_")]
    out: dict[str, list[tuple[int, dict]]] = {}
    if names:
        for r in spark.read.text(names, wholetext=True).selectExpr("value", "_metadata.file_path AS path").collect():
            folder, name = r["path"].rsplit("/", 2)[1:]
            out.setdefault(unquote(folder), []).append((int(name.split(".")[0]), json.loads(r["value"])))
    return {k: sorted(v, key=lambda x: x[0]) for k, v in out.items()}


def records(spark: SparkSession, folder: str) -> list[tuple[int, dict]]:
    """All records of a folder in order of number."""
    return next(iter(records_by_folder(spark, folder).values()), [])
