"""Row counts from Parquet footers.

A count is pushed into the scan by the version-2 Parquet source with aggregate push-down: each
task reads the footers of its files and returns their row counts, no column chunk is opened.  That source
is switched on in a session of its own, so the caller's settings stay as they are.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def footer_session(spark: SparkSession) -> SparkSession:
    """A session on the same cluster whose Parquet scans answer counts from footers."""
    other = spark.newSession()
    # the sources that stay on version 1: all but Parquet
    other.conf.set("spark.sql.sources.useV1SourceList", "avro,csv,json,kafka,orc,text")
    other.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    return other


def footer_counts(spark: SparkSession, folders: dict[str, list[str]], schemas: dict[str, T.StructType]) -> DataFrame:
    """TABLE_NAME, ROW_COUNT of tables given as lists of Parquet folders (none: 0 rows)."""
    other, parts = footer_session(spark), []
    for name in sorted(folders):
        if folders[name]:
            count = other.read.schema(schemas[name]).parquet(*folders[name]).agg(F.count(F.lit(1)).alias("ROW_COUNT"))
            parts.append(count.select(F.lit(name).alias("TABLE_NAME"), "ROW_COUNT"))
        else:
            parts.append(other.range(1).select(F.lit(name).alias("TABLE_NAME"), F.lit(0).cast("long").alias("ROW_COUNT")))
    return reduce(DataFrame.unionAll, parts).orderBy("TABLE_NAME")
