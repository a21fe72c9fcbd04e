"""Trusted-layer sinks (B1, B4).

``publish`` materialises a reporting view for dashboards as Parquet
partitioned by calendar year, so yearly dashboard filters prune files; the
write is a full refresh (``overwrite``) or an ``append`` load.  Rows are
brought together by year with a rebalance, which adaptive execution splits
where one year is large, and files are cut at ``max_records`` rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def publish(df: DataFrame, path: str, partition_by: str | None = "CalendarYear",
            mode: str = "overwrite", max_records: int = 5_000_000) -> None:
    if partition_by:
        w = df.hint("rebalance", partition_by).write.partitionBy(partition_by)
    else:
        w = df.write
    w.mode(mode).option("maxRecordsPerFile", max_records).parquet(path)


def republish(view: DataFrame, increment: DataFrame, path: str, partition_by: str = "CalendarYear", max_records: int = 5_000_000) -> list:
    """Write again only the partitions of a published table that an increment touches; returns their values.

    ``increment`` is the view over the new rows alone, ``view`` over all rows.  The filter on touched values reaches the
    date dimension, so the rebuilt part reads no other years' rows past that join; files of other partitions stay as they are."""
    touched = [r[0] for r in increment.select(partition_by).distinct().collect()]  # a row a year
    if not touched:
        return []
    own = F.col(partition_by).isin([v for v in touched if v is not None])
    rows = view.where(own | F.col(partition_by).isNull() if None in touched else own)
    (rows.hint("rebalance", partition_by).write.partitionBy(partition_by).mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").option("maxRecordsPerFile", max_records).parquet(path))
    return sorted(touched, key=str)
