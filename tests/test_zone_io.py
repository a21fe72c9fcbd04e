"""Raw-zone persistence: Parquet + manifest, bucketed catalog tables, publish."""

import os

import pytest
from pyspark.sql import functions as F

from ledgerlake import schemas
from ledgerlake.plans import views
from ledgerlake.plans.ingest_queries import stage_extracts
from ledgerlake.session import local_path
from ledgerlake.sinks.parquet import publish
from ledgerlake.sources.zone import RawZone


def test_parquet_zone_round_trip(spark, zone, tmp_stage):
    counts = zone.write(f"{tmp_stage}/zone")
    back = RawZone.from_parquet(spark, f"{tmp_stage}/zone")
    assert back.size("RAW_DIMSTORE")[0] == counts["RAW_DIMSTORE"] == zone["RAW_DIMSTORE"].count()
    assert back["RAW_FACTSALES"].exceptAll(zone["RAW_FACTSALES"]).count() == 0
    assert zone["RAW_FACTSALES"].exceptAll(back["RAW_FACTSALES"]).count() == 0
    assert views.rpt_sales_master(back).count() == views.rpt_sales_master(zone).count()


def test_bucketed_zone_dedup_without_fact_shuffle(spark, zone, tmp_stage):
    counts = zone.write_tables("zone_test", f"{tmp_stage}/tables", 4)
    bz = RawZone.from_catalog(spark, "zone_test", counts)
    clean = views.clean_sales(bz)
    plan = clean._jdf.queryExecution().executedPlan().toString()
    # every exchange in the plan is a broadcast of a dimension
    lines = [ln for ln in plan.splitlines() if "Exchange" in ln]
    assert lines and all("Broadcast" in ln or "SinglePartition" in ln or "hashpartitioning(d#" in ln
                         or "p_size" in ln for ln in lines), plan
    assert clean.count() == views.clean_sales(zone).count()


def test_publish_partitioned_by_year(spark, zone, tmp_stage):
    out = f"{tmp_stage}/rpt"
    publish(views.rpt_sales_master(zone), out)
    years = sorted(d for d in os.listdir(local_path(out)) if d.startswith("CalendarYear="))
    assert years
    back = spark.read.parquet(out)
    assert back.count() == views.rpt_sales_master(zone).count()
    one = years[0].split("=")[1]
    assert back.where(F.col("CalendarYear") == int(one)).count() > 0


def test_one_large_year_is_split(spark, tmp_stage):
    rows = spark.range(0, 60_000, 1, 8).select(F.col("id"), F.sha2(F.col("id").cast("string"), 256).alias("t"),
                                               F.when(F.col("id") % 100 == 0, 2000).otherwise(2001).alias("CalendarYear"))
    old = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes", None)
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "256k")
    try:
        publish(rows, f"{tmp_stage}/years")
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes") if old is None else \
            spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", old)
    files = [f for f in os.listdir(local_path(f"{tmp_stage}/years/CalendarYear=2001")) if f.endswith(".parquet")]
    assert len(files) > 2 and spark.read.parquet(f"{tmp_stage}/years").count() == 60_000


def test_repeated_outrigger_keys_are_not_hinted(zone):
    big = {**{n: (10, 1) for n in zone.tables}, "RAW_DIMSTORE": (1000, 1), "RAW_DIMGEOGRAPHY": (48_000, 1400)}
    plan = lambda z: views.store_dim(z)._jdf.queryExecution().analyzed().toString()
    top = lambda z: plan(z).splitlines()[0]
    assert "ResolvedHint" not in top(RawZone(zone.tables, big))
    assert "ResolvedHint" in top(RawZone(zone.tables, {**big, "RAW_DIMGEOGRAPHY": (48_000, 1)}))


def test_zone_from_csv_and_abort(spark, zone, tmp_stage):
    stage_extracts(zone, f"{tmp_stage}/stage")
    loaded = RawZone.from_csv(spark, f"{tmp_stage}/stage", f"{tmp_stage}/zone")
    for name in zone.tables:
        assert loaded[name].count() == zone[name].count(), name
    with open(f"{local_path(tmp_stage)}/stage/DimGeography.csv/bad.csv", "w") as fh:
        fh.write(",".join(f.name for f in schemas.RAW_DIMGEOGRAPHY.fields) + "\nnot a number,a,b,c,d,e\n")
    with pytest.raises(Exception, match="load aborted"):
        RawZone.from_csv(spark, f"{tmp_stage}/stage", f"{tmp_stage}/zone")
    assert RawZone.current(spark, f"{tmp_stage}/zone")["RAW_DIMGEOGRAPHY"].count() == zone["RAW_DIMGEOGRAPHY"].count()


def test_scratch_is_removed_on_request(spark):
    from ledgerlake.session import remove_scratch, scratch_path
    paths = [scratch_path(spark, p) for p in ("to-remove", "to-keep")]
    for p in paths:
        spark.range(3).write.parquet(p)
    assert remove_scratch(spark, "to-remove") and not remove_scratch(spark, "to-remove")
    assert not os.path.exists(local_path(paths[0])) and spark.read.parquet(paths[1]).count() == 3
