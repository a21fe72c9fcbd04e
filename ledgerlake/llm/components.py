"""Connected components by contraction, for link tables of any size.

Each round points every vertex at its smallest neighbour under a fresh random
priority, renames the ends of all links accordingly and drops loops; the
expected number of vertices falls by a constant factor a round whatever the
shape (long chains included).  Neighbour lists are never gathered: a vertex
with a third of all links is a ``min`` with map-side combine and a join that
adaptive execution may split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.llm.scratch import Scratch


def components(spark: SparkSession, links: DataFrame, scratch: Scratch) -> DataFrame:
    """links (a, b) -> (v, component): the smallest vertex reachable from v, for every v with a link.

    Loops and rows with a null end are ignored; an empty table gives no rows.
    """
    links = links.select(F.col("a").cast("long").alias("a"), F.col("b").cast("long").alias("b")) \
        .where("a <> b")
    edges = scratch.table(links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    vertices = edges.select(F.col("a").alias("v")).union(edges.select("b")).distinct()
    names, salt = None, 0
    while edges.limit(1).count():
        salt += 1
        both = edges.union(edges.select("b", "a"))
        order = lambda c: F.struct(F.xxhash64(c, F.lit(salt)).alias("h"), F.col(c).alias("v"))
        near = both.groupBy("a").agg(F.min(F.xxhash64("b", F.lit(salt))).alias("h"))
        # ties of the hash: the smaller vertex; hash and vertex travel as two longs so that the
        # aggregation keeps fixed-width buffers
        near = both.withColumn("h", F.xxhash64("b", F.lit(salt))).join(near, ["a", "h"]) \
            .groupBy("a", "h").agg(F.min("b").alias("b"))
        step = near.select(F.col("a").alias("v"), F.when(
            F.struct("h", F.col("b").alias("v")) < order("a"), F.col("b")).otherwise(F.col("a")).alias("p"))
        step = scratch.table(step)
        new = edges.join(step.toDF("a", "pa"), "a").join(step.toDF("b", "pb"), "b").where("pa <> pb") \
            .select(F.least("pa", "pb").alias("a"), F.greatest("pa", "pb").alias("b")).distinct()
        new = scratch.table(new)
        if names is None:
            names = step
        else:
            moved = names.join(step.select(F.col("v").alias("p"), F.col("p").alias("q")), "p", "left") \
                .select("v", F.coalesce("q", "p").alias("p"))
            names = scratch.table(moved)
        edges = new
    if names is None:
        return vertices.select("v", F.col("v").alias("component")).where(F.lit(False))
    least = names.groupBy("p").agg(F.min("v").alias("component"))
    return names.join(least, "p").select("v", "component")
