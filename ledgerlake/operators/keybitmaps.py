"""Exact key uniqueness of a growing table, kept as bitmaps.

Each bucket of 32,768 consecutive keys has two bitmaps: the keys seen, and those seen on more than
one row.  An increment is reduced to its own two bitmaps a bucket and merged into the buckets that it touches:
keys seen in both the state and the increment (an AND) join the repeated ones.  So the distinct and duplicate
counts of a grown fact cost the new rows and the touched buckets, not a pass over all keys.

Buckets lie in parts of ``PART`` buckets, a folder each; one log entry names the folders and counts of the rewritten
parts, with the rows and NULL keys of the increment.  All bigint keys are exact, negative ones too; a
NULL key is no distinct key, and a duplicate group of its own if it stands on several rows.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.sinks.commitlog import CommitLog, Conflict, remove

#: 4,096 buckets hold 134 M keys in at most 32 MB.
PART = 4096
_STATE = "part long, bucket long, seen binary, repeated binary"


class KeyBitmaps:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self.log = CommitLog(spark, f"{self.path}/log")

    @staticmethod
    def _parts(entries: list[dict]) -> dict[str, dict]:
        out: dict[str, dict] = {}
        for e in entries:
            out.update(e["parts"])
        return out

    def add(self, rows: DataFrame, key: str, name: str | None = None) -> dict:
        """Count an increment's keys in; one that is already counted under this name is skipped.  Returns :meth:`counts`."""
        folder = f"{self.path}/data/{uuid.uuid4().hex}"
        per_key = rows.groupBy(F.col(key).cast("long").alias("key")).agg(F.count(F.lit(1)).alias("n"))
        per_key.write.parquet(f"{folder}/keys")
        per_key = self.spark.read.schema("key long, n long").parquet(f"{folder}/keys")
        total = per_key.agg(F.sum("n").alias("rows"), F.sum(F.when(F.col("key").isNull(), F.col("n"))).alias("nulls")).first()
        bit, bucket = F.bitmap_bit_position("key"), F.bitmap_bucket_number("key")
        new = per_key.where("key is not null").groupBy(bucket.alias("bucket")).agg(
            F.bitmap_construct_agg(bit).alias("seen"), F.bitmap_construct_agg(F.when(F.col("n") > 1, bit)).alias("repeated")) \
            .select(F.floor(F.col("bucket") / PART).alias("part"), "bucket", "seen", "repeated")
        touched = sorted(str(r[0]) for r in new.select("part").distinct().collect())  # a number a touched part
        tried = 0
        while True:
            entries = self.log.entries()
            if name is not None and any(e["name"] == name for e in entries):
                remove(self.spark, folder)
                return self.counts()
            have = self._parts(entries)
            old = [have[p]["folder"] for p in touched if p in have]
            tried += 1
            out = f"{folder}/merged-{tried}"
            both = new.unionByName(self.spark.read.schema(_STATE).parquet(*old)) if old else new
            # a bucket has one row of the state at most and one of the increment
            merged = both.repartition("part").groupBy("part", "bucket").agg(
                F.bitmap_or_agg("seen").alias("seen"), F.bitmap_or_agg("repeated").alias("r"),
                F.when(F.count(F.lit(1)) > 1, F.bitmap_and_agg("seen")).alias("again"))
            merged = merged.select("part", "bucket", "seen", F.explode(F.array_compact(F.array("r", "again"))).alias("r")) \
                .groupBy("part", "bucket", "seen").agg(F.bitmap_or_agg("r").alias("repeated"))
            merged.withColumn("folder", F.col("part")).write.partitionBy("folder").parquet(out)
            sums = self.spark.read.schema(_STATE).parquet(out).groupBy("part").agg(
                F.sum(F.bitmap_count("seen")).alias("seen"), F.sum(F.bitmap_count("repeated")).alias("repeated"))
            parts = {str(r["part"]): {"folder": f"{out}/folder={r['part']}", "distinct": r["seen"], "repeated": r["repeated"]}
                     for r in sums.collect()}  # a row a touched part

            def unchanged(now: list[dict], have=have) -> bool:
                there = self._parts(now)
                return all(there.get(p) == have.get(p) for p in touched) and not any(name is not None and e["name"] == name for e in now)
            try:
                self.log.append({"name": name, "parts": parts, "rows": total["rows"] or 0, "nulls": total["nulls"] or 0}, unchanged)
            except Conflict:
                remove(self.spark, out)
                continue
            remove(self.spark, f"{folder}/keys")
            return self.counts()

    def counts(self) -> dict:
        """rows, distinct keys, duplicate groups and NULL keys of all increments so far, from the log alone."""
        entries = self.log.entries()
        parts, nulls = self._parts(entries).values(), sum(e["nulls"] for e in entries)
        return {"rows": sum(e["rows"] for e in entries), "distinct": sum(p["distinct"] for p in parts),
                "repeated": sum(p["repeated"] for p in parts) + (nulls > 1), "nulls": nulls}
