"""Aggregate building blocks of the quality suite.

Every check computes its numbers in one aggregation pass per input (map-side
partial aggregation, one tiny shuffle) and then, where the reference emits
several labelled rows, combines 1-row results with ``unionByName``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def cond_count(pred: Column) -> Column:
    """``SUM(CASE WHEN pred THEN 1 ELSE 0 END)``: NULL on empty input, like SQL."""
    return F.sum(F.when(pred, F.lit(1)).otherwise(F.lit(0))).cast("bigint")


def row_count(alias: str = "row_count") -> Column:
    return F.count(F.lit(1)).alias(alias)


def duplicate_groups(df: DataFrame, key: str) -> DataFrame:
    """Keys occurring more than once, with their counts (NULL keys form one group)."""
    return (df.groupBy(key).agg(F.count(F.lit(1)).alias("_cnt"))
            .where(F.col("_cnt") > 1))


def count_of(df: DataFrame, alias: str) -> DataFrame:
    """1-row frame: ``SELECT COUNT(*) AS alias FROM df``."""
    return df.agg(F.count(F.lit(1)).alias(alias))


def union_all(frames: list[DataFrame]) -> DataFrame:
    """``UNION ALL`` by name (the reference relies on first-branch names)."""
    return reduce(lambda a, b: a.unionByName(b), frames)


def labelled(df: DataFrame, **labels: str) -> DataFrame:
    """Prepend constant label columns to a (1-row) result."""
    cols = [F.lit(v).alias(k) for k, v in labels.items()]
    return df.select(*cols, *df.columns)
