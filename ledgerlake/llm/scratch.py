"""Intermediate tables in the shared folder that the cluster names.

Iterative operators cut their lineage by writing a Parquet table below the
folder of ``spark.checkpoint.dir`` and reading it again: a lost executor then
costs a re-read of shared files, never a recomputation of the whole chain.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from ledgerlake.session import scratch_path


class Scratch:
    """Written tables of one operator run; ``drop`` removes those no longer read."""

    def __init__(self, spark: SparkSession, purpose: str):
        self.spark = spark
        self.base = scratch_path(spark, purpose)
        self.n = 0

    def table(self, df: DataFrame) -> DataFrame:
        self.n += 1
        path = f"{self.base}/{self.n}"
        df.write.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        out._scratch = path  # for drop()
        return out

    def drop(self, *tables: DataFrame) -> None:
        jvm = self.spark._jvm
        for t in tables:
            path = jvm.org.apache.hadoop.fs.Path(t._scratch)
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def smallest(rows: DataFrame, n: int, h: str, *ties: str) -> list[Row]:
    """The n rows with the smallest values of a uniform 64-bit hash column, ties broken by the columns named.

    The rows are counted first and those beyond the quantile that n needs (with a wide margin) dropped where they are, so
    all tasks together send the driver about n rows, not n each."""
    total = rows.count()
    if total > 2 * n + 100:
        share = (n + 8 * math.sqrt(n) + 50) / total
        near = rows.where(F.col(h) < F.lit(int(-(1 << 63) + share * (1 << 64))))
        found = near.orderBy(h, *ties).limit(n).collect()
        if len(found) == n:
            return found
    # few rows, or hashes that aren't spread (many rows of one value): all take part
    return rows.orderBy(h, *ties).limit(n).collect()
