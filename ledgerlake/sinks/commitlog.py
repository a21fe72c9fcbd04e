"""A log of committed loads, and the table that it makes visible.

A load writes its rows to a data folder of its own and becomes visible by one
entry of the log: a numbered JSON file that is written aside and renamed into
place only if no other holds that number.  Readers open the folders that entries
name, so a torn write (no entry) is invisible, and so are rows of a load
that is still running.  Each entry also lists the files it loaded with path, size,
modification time and counts: the history that a later load consults to skip
what it has and to read again what has changed.

One entry a load is read by the driver; entries grow with the number of loads and their
files, never with rows.
"""

from __future__ import annotations

import json
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

FILES = T.StructType([T.StructField(n, t) for n, t in [
    ("path", T.StringType()), ("size", T.LongType()), ("modified", T.LongType()), ("parsed", T.LongType()), ("loaded", T.LongType()),
    ("rejected", T.LongType()), ("first_reason", T.StringType()), ("first_record", T.LongType())]])


class Conflict(RuntimeError):
    """Another load has committed the same files."""


def _is_a(error: Py4JJavaError, name: str) -> bool:
    e = error.java_exception
    while e is not None:
        if e.getClass().getName().endswith(name):
            return True
        e = e.getCause()
    return False


def put_if_absent(spark: SparkSession, path: str, text: str) -> bool:
    """Create a file with this text, whole or not at all; False if it exists."""
    hadoop, conf = spark._jvm.org.apache.hadoop.fs, spark._jsc.hadoopConfiguration()
    target = hadoop.Path(path)
    aside = hadoop.Path(target.getParent(), f".{target.getName()}.{uuid.uuid4().hex}")
    files = target.getFileSystem(conf)
    out = files.create(aside, False)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    rename = getattr(hadoop, "Options$Rename")
    options = spark.sparkContext._gateway.new_array(rename, 1)
    options[0] = rename.NONE
    try:
        hadoop.FileContext.getFileContext(target.toUri(), conf).rename(aside, target, options)
        return True
    except Py4JJavaError as e:
        files.delete(aside, False)
        if _is_a(e, "FileAlreadyExistsException"):
            return False
        raise


def exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def remove(spark: SparkSession, path: str) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


class CommitLog:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def entries(self) -> list[dict]:
        """All entries in the order of their numbers."""
        if not exists(self.spark, self.path):
            return []
        texts = [r[0] for r in self.spark.read.text(self.path, wholetext=True).collect()]  # an entry a load
        return sorted((json.loads(t) for t in texts), key=lambda e: e["number"])

    def append(self, entry: dict, allowed=lambda others: True) -> int:
        """Commit an entry under the next free number.  ``allowed`` is asked again with all entries whenever
        another writer came first; if it refuses, nothing is committed."""
        while True:
            others = self.entries()
            if not allowed(others):
                raise Conflict("another load has committed the same files")
            number = others[-1]["number"] + 1 if others else 0
            if put_if_absent(self.spark, f"{self.path}/{number:012d}.json", json.dumps({**entry, "number": number})):
                return number


class LoadedTable:
    """A table of committed loads under a folder: ``log`` and one folder of ``data`` a load."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType):
        self.spark, self.path, self.schema = spark, path.rstrip("/"), schema
        self.log = CommitLog(spark, f"{self.path}/log")

    def new_folder(self) -> str:
        return f"{self.path}/data/{uuid.uuid4().hex}"

    def commit(self, folder: str, files: list[dict], key: str | None = None, profile: dict | None = None) -> int:
        """Make a written folder visible; refused if a load with this key, or with one of these files as they are, is committed."""
        mine = {_state(f) for f in files}

        def allowed(others: list[dict]) -> bool:
            return not any((key is not None and e["key"] == key) or mine & {_state(f) for f in e["files"]} for e in others)
        return self.log.append({"key": key, "folder": folder, "files": files, "profile": profile or {}}, allowed)

    def has(self, key: str) -> bool:
        return any(e["key"] == key for e in self.log.entries())

    def snapshot(self, up_to: int | None = None) -> DataFrame:
        """The rows of all committed loads (up to an entry's number); none, with the declared columns, before the first."""
        return self._rows("good", "loaded", self.schema, up_to)

    def increment(self, number: int) -> DataFrame:
        """The rows that one commit added."""
        return self._rows("good", "loaded", self.schema, number, number)

    def quarantine(self) -> DataFrame:
        """The rejected records of all committed loads: fields as text, file, place and reason."""
        from ledgerlake.sources.loads import QUARANTINE
        return self._rows("bad", "rejected", QUARANTINE)

    def history(self) -> DataFrame:
        """One row for each file of each load: commit number, path, size, modification time, records parsed, loaded and
        rejected, and the reason and record number of the first rejected one."""
        rows = [(e["number"], *[f[c.name] for c in FILES.fields]) for e in self.log.entries() for f in e["files"]]
        return self.spark.createDataFrame(rows, T.StructType([T.StructField("commit", T.LongType()), *FILES.fields]))

    def _rows(self, verdict: str, counted: str, schema: T.StructType, last: int | None = None, first: int = 0) -> DataFrame:
        folders = [f"{e['folder']}/verdict={verdict}" for e in self.log.entries()
                   if first <= e["number"] and (last is None or e["number"] <= last) and any(f[counted] for f in e["files"])]
        if not folders:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*folders)


def _state(f: dict) -> tuple:
    return f["path"], f["size"], f["modified"]
