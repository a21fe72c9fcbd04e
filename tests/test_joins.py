"""Join operators: NOT IN semantics, orphan counting, timestamp = date keys."""

import itertools

import duckdb
import pytest
from pyspark.sql import functions as F

from ledgerlake.operators.joins import key_flags, not_in_true, orphan_count

DIMS = {"plain": [1, 2], "with_null": [1, None], "empty": []}
FACT = [(1, 10), (3, 20), (None, 40), (2, 80)]


def _spark_not_in_or(spark, dim_a, dim_b):
    f = spark.createDataFrame(FACT, "a bigint, v bigint").withColumn("b", F.col("a"))
    da = spark.createDataFrame([(x,) for x in dim_a], "k bigint")
    db = spark.createDataFrame([(x,) for x in dim_b], "k bigint")
    out, cond = f, None
    for col, dim, tag in (("a", da, "A"), ("b", db, "B")):
        present, empty, has_null = key_flags(dim, "k", tag)
        out = out.join(present, F.col(col) == F.col(f"{tag}_key"), "left")
        c = not_in_true(F.col(col), F.col(f"{tag}_present"), empty, has_null)
        cond = c if cond is None else cond | c
    return sorted(r["v"] for r in out.where(cond).select("v").collect())


def _duck_not_in_or(dim_a, dim_b):
    con = duckdb.connect()
    con.execute("CREATE TABLE f(a BIGINT, v BIGINT)")
    con.executemany("INSERT INTO f VALUES (?, ?)", FACT)
    for name, vals in (("da", dim_a), ("db", dim_b)):
        con.execute(f"CREATE TABLE {name}(k BIGINT)")
        if vals:
            con.executemany(f"INSERT INTO {name} VALUES (?)", [(x,) for x in vals])
    rows = con.execute("SELECT v FROM f WHERE a NOT IN (SELECT k FROM da) "
                       "OR a NOT IN (SELECT k FROM db)").fetchall()
    return sorted(r[0] for r in rows)


@pytest.mark.parametrize("a,b", list(itertools.product(DIMS, DIMS)))
def test_not_in_or_matches_sql(spark, a, b):
    assert _spark_not_in_or(spark, DIMS[a], DIMS[b]) == _duck_not_in_or(DIMS[a], DIMS[b])


def test_orphan_count_counts_null_keys(spark):
    f = spark.createDataFrame([(1,), (1,), (5,), (None,), (-1,), (-1,)], "k bigint")
    d = spark.createDataFrame([(1,), (1,), (None,)], "k bigint")
    got = orphan_count(f, F.col("k"), d, F.col("k")).collect()[0]["Fail_Count"]
    ref = (f.alias("f").join(d.alias("d"), F.col("f.k") == F.col("d.k"), "left")
           .where(F.col("d.k").isNull()).count())
    assert got == ref == 4


def test_orphan_count_empty_is_zero(spark):
    f = spark.createDataFrame([(1,)], "k bigint")
    got = orphan_count(f, F.col("k"), f, F.col("k")).collect()[0]["Fail_Count"]
    assert got == 0


def test_timestamp_to_date_key_midnight_only(spark):
    f = spark.sql("SELECT * FROM VALUES (TIMESTAMP_NTZ'2000-01-01 00:00:00'), "
                  "(TIMESTAMP_NTZ'2000-01-01 01:00:00') AS t(ts)")
    d = spark.sql("SELECT DATE'2000-01-01' AS dk")
    j = f.join(d.select(F.col("dk").cast("timestamp_ntz").alias("dts")),
               F.col("ts") == F.col("dts"), "inner")
    assert j.count() == 1
