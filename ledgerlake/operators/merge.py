"""A keep-latest view that increments maintain: merge on the key, rewriting touched buckets only.

Rows lie in buckets of ``width`` consecutive keys (NULL keys in one of their own, negative
keys in buckets below zero), each bucket one folder with one row a key.  New sales carry new keys, so an
increment touches few buckets; it is reduced to its latest row a key, joined by the rows of the
touched buckets alone, reduced again, and written to fresh folders.  One log entry then names the folder of each
rewritten bucket: readers see all of a merge or nothing, other buckets keep their files, and old
folders stay readable for running queries until :meth:`MergedView.vacuum`.

The driver handles one number a touched bucket, and a map of buckets to folders (keys / width entries).
Keep-latest is associative, so any cut of the rows into increments gives the view over all rows.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlake.operators.dedup import keep_latest
from ledgerlake.sinks.commitlog import CommitLog, Conflict, exists, remove

BUCKET = "_bucket"
RANK = "RowRank"
NO_KEY = "null"


class MergedView:
    """``schema``: the view's columns without the rank; ``width``: keys a bucket."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, key: str, order_col: str = "DateKey", width: int = 1 << 20):
        self.spark, self.path, self.schema = spark, path.rstrip("/"), schema
        self.key, self.order_col, self.width = key, order_col, width
        self.log = CommitLog(spark, f"{self.path}/log")

    def _bucket(self) -> Column:
        return F.coalesce(F.floor(F.col(self.key) / F.lit(self.width)).cast("string"), F.lit(NO_KEY))

    def _latest(self, rows: DataFrame) -> DataFrame:
        return keep_latest(rows, self.key, self.order_col, RANK).drop(RANK)

    @staticmethod
    def _folders(entries: list[dict]) -> dict[str, str]:
        """The folder of each bucket after all entries."""
        out: dict[str, str] = {}
        for e in entries:
            out.update(e["buckets"])
        return out

    def folders(self) -> dict[str, str]:
        return self._folders(self.log.entries())

    def _open(self, folders: list[str]) -> DataFrame:
        if not folders:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*folders)

    def read(self) -> DataFrame:
        """The view: the latest row of each key, with its rank (always 1)."""
        return self._open(sorted(self.folders().values())).withColumn(RANK, F.lit(1))

    def merge(self, rows: DataFrame, key: str | None = None) -> list[str]:
        """Upsert rows of the view's columns; returns the buckets that were rewritten.

        ``key`` names the increment: one that is already merged under this name is skipped.  A merge that
        another one overtook on a common bucket starts again from what is there now."""
        names = [f.name for f in self.schema.fields]
        entries = self.log.entries()
        if any(key is not None and e["key"] == key for e in entries):
            return []  # before any row is computed
        folder = f"{self.path}/data/{uuid.uuid4().hex}"
        staged = f"{folder}/increment"
        latest = self._latest(rows.select(*names)).withColumn(BUCKET, self._bucket())
        first = not entries  # nothing to merge with: its rows are written as buckets at once
        (latest.repartition(BUCKET).write.partitionBy(BUCKET) if first else latest.write).parquet(staged)
        schema = T.StructType([*self.schema.fields, T.StructField(BUCKET, T.StringType())])
        new = self.spark.read.schema(schema).parquet(staged)
        touched = sorted(r[0] for r in new.select(BUCKET).distinct().collect())  # a name a touched bucket
        tried = 0
        while True:
            entries = self.log.entries()
            if not touched or any(key is not None and e["key"] == key for e in entries):
                remove(self.spark, folder)
                return []
            have = self._folders(entries)
            as_staged = first and not entries
            tried += 1
            out = staged if as_staged else f"{folder}/merged-{tried}"
            if not as_staged:
                self._merge_buckets(new, touched, have, out)
            buckets = {b: f"{out}/{BUCKET}={b}" for b in touched}

            def unchanged(now: list[dict], have=have) -> bool:
                there = self._folders(now)
                return all(there.get(b) == have.get(b) for b in touched) and not any(key is not None and e["key"] == key for e in now)
            try:
                self.log.append({"key": key, "buckets": buckets}, unchanged)
            except Conflict:
                if not as_staged:
                    remove(self.spark, out)
                continue
            if not as_staged:
                remove(self.spark, staged)
            return touched

    def _merge_buckets(self, new: DataFrame, touched: list[str], have: dict[str, str], out: str) -> None:
        old = self._open([have[b] for b in touched if b in have]).withColumn(BUCKET, self._bucket())
        # one bucket is at most 2 * width rows: a task ranks it and writes its one file
        both = old.unionByName(new).repartition(BUCKET)
        keep_latest(both, self.key, self.order_col, RANK, within=(BUCKET,)).drop(RANK).write.partitionBy(BUCKET).parquet(out)

    def vacuum(self) -> int:
        """Delete bucket folders that no reader of the current state needs; returns how many."""
        entries = self.log.entries()
        live, gone = set(self._folders(entries).values()), 0
        for e in entries:
            for folder in e["buckets"].values():
                if folder not in live and exists(self.spark, folder):
                    remove(self.spark, folder)
                    gone += 1
        return gone
