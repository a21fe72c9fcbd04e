"""What keeps queries linear beyond the size of a broadcast: narrow shuffles, loads that convert once, merges that skip."""

import glob
import os
import time

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlake.operators.joins import GRID_MAX_COPIES, GRID_MAX_ROWS, SHUFFLED, DimJoin, _grid, star_join
from ledgerlake.operators.merge import MergedView
from ledgerlake import schemas
from ledgerlake.plans import ingest_queries, load_queries, views
from ledgerlake.plans.ingest_queries import stage_extracts
from ledgerlake.plans.load_queries import with_fact
from ledgerlake.registry import QUERIES
from ledgerlake.session import SHUFFLE_CLEANUP, local_path, shuffles_removed
from ledgerlake.sinks import csv as sink
from ledgerlake.sources import csv as ingest
from ledgerlake.sources.loads import write_flagged
from ledgerlake.sources.zone import BROADCAST_MAX_ROWS, RawZone


def large(zone: RawZone) -> RawZone:
    """The zone with products and customers said to be too many for a broadcast."""
    sizes = {n: (10, 1) for n in zone.tables if "FACT" not in n}
    return RawZone(zone.tables, {**sizes, **{n: (BROADCAST_MAX_ROWS + 1, 2) for n in ("RAW_DIMPRODUCT", "RAW_DIMCUSTOMER")}})


def test_texts_join_after_the_shuffles(zone):
    z = large(zone)
    at = views._store_star(z, views.DROP, True).columns.index
    assert at("pro_PromotionKey") < at("p_ProductKey") < at("s_StoreName") < at("sub_ProductSubcategoryName")
    at = views._online_star(z, views.DROP, True).columns.index
    assert at("c_CustomerKey") < at("p_ProductKey") < at("cur_CurrencyName") < at("g_RegionCountryName")


@pytest.mark.parametrize("name", ["rpt_sales_master", "rpt_online_master", "master_sales_v1_left", "master_online_v1_left", "sea_online_performance"])
def test_large_dimensions_are_hashed_without_a_sort(spark, zone, name):
    rows = lambda df: sorted(map(tuple, df.collect()), key=repr)
    expected = rows(QUERIES[name](zone))
    df = QUERIES[name](large(zone))
    assert rows(df) == expected
    assert "ShuffledHashJoin" in df._jdf.queryExecution().executedPlan().toString()


def test_many_rows_of_a_key_or_a_partition_are_not_hashed(spark, zone):
    name, partitions = "RAW_DIMPRODUCT", int(spark.conf.get("spark.sql.shuffle.partitions"))
    known = lambda size: RawZone(zone.tables, {name: size}).hashable(name)
    assert known((600_000, 2)) and not known((600_000, 5_000)) and not known((partitions * 1_000_000, 1))
    assert not RawZone(zone.tables, {}).hashable(name)


def test_first_failing_rule_with_values_converted_once(spark, tmp_stage):
    long, text = T.LongType(), T.StringType()
    schema, fmt = T.StructType([T.StructField("k", long), T.StructField("name", text, True, {"max_length": 5}), T.StructField("n", long)]), ingest.CsvFormat()
    assert "try_cast" not in str(ingest.reject_reason(schema, fmt, {n: F.col(n) for n in schema.names})).lower()
    lines = ["1,ok,", "x,fine,1", "2,NULL,null", "y,too long,z", "3,too long,z", "4,a,z", "5,too,many,fields"]
    sink.write_lines(spark.createDataFrame([(r,) for r in lines], "line string").coalesce(1), "k,name,n", f"{tmp_stage}/in")
    raw = ingest.read_text(spark, f"{tmp_stage}/in", schema, fmt, places=True)
    seen = write_flagged(raw, schema, fmt, f"{tmp_stage}/out")
    assert (seen["parsed"], seen["rejected"]) == (7, 5)
    bad = [r[0] for r in spark.read.parquet(f"{tmp_stage}/out").where("verdict = 'bad'").orderBy("_place").select(ingest.REASON).collect()]
    assert [b.split(":")[0] for b in bad] == ["k", "k", "name", "n", "n"]
    good = spark.read.parquet(f"{tmp_stage}/out").where("verdict = 'good'").orderBy("_place").select("k", "name", "n").collect()
    assert [tuple(r) for r in good] == [(1, "ok", None), (2, None, None)]


def test_staged_files_are_bounded(spark, tmp_stage, monkeypatch):
    monkeypatch.setattr(sink, "MAX_RECORDS", 10)
    rows = spark.range(35).select(F.col("id").cast("string").alias("k")).coalesce(1)
    sink.write_csv(rows, f"{tmp_stage}/plain")
    assert len(glob.glob(f"{local_path(tmp_stage)}/plain/part-*")) == 4
    assert sink.stage_named(rows, f"{tmp_stage}/named", "Fact") == 4
    assert spark.read.option("header", True).csv(f"{tmp_stage}/named").distinct().count() == 35


def test_repeated_increment_is_not_computed(spark, tmp_stage):
    rows = spark.range(40).select(F.col("id").alias("k"), F.lit(1).alias("DateKey"))
    view = MergedView(spark, f"{tmp_stage}/m", rows.schema, "k", width=10)
    assert view.merge(rows, key="day 0") == ["0", "1", "2", "3"]
    # the first increment is written once, as buckets
    assert {os.path.basename(os.path.dirname(p)) for p in view.folders().values()} == {"increment"}
    torn = rows.withColumn("DateKey", F.raise_error(F.lit("computed")).cast("int"))
    assert view.merge(torn, key="day 0") == []
    later = spark.range(35, 45).select(F.col("id").alias("k"), F.lit(2).alias("DateKey"))
    assert view.merge(later, key="day 1") == ["3", "4"]
    assert sorted(tuple(r) for r in view.read().collect()) == [(k, 2 if k >= 35 else 1, 1) for k in range(45)]


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["master_online", "export_rpt_online", "rpt_online_master", "duplicate_key_listing", "duplicate_suite", "master_online_v1_left"])
def test_two_large_dimensions_cost_one_shuffle_of_the_fact(zone, name):
    rows = lambda df: sorted(map(tuple, df.collect()), key=repr)
    df = QUERIES[name](large(zone))
    plan = plan_of(df)
    # the fact and copies of both dimensions meet in the cells of one grid, then nothing is dealt by a dimension's key
    assert plan.count("Exchange shufflepartitionidpassthrough") == 3
    if not name.startswith("duplicate"):
        assert not any(f"Exchange hashpartitioning({key}Key" in plan for key in ("Customer", "Product", "c_Customer", "p_Product"))
    assert rows(df) == rows(QUERIES[name](zone))


@pytest.mark.parametrize("how", ["inner", "left"])
def test_grid_meets_each_pair_once(spark, how):
    fact = spark.createDataFrame([(i, i % 13 if i % 11 else None, i % 9 - 1) for i in range(300)], "k long, x long, y long")
    # keys that come twice, keys without a row, null keys
    dim = lambda p, keys: spark.createDataFrame([(k, f"{p}{n}") for n, k in enumerate(keys)], f"{p}_k long, {p}_t string")
    a, b = dim("a", [*range(10), 3, 3, None]), dim("b", [0, 1, 2, 3, 5, 5, None])
    joins = [DimJoin(a, "x", "a_k", how, SHUFFLED, rows=3_000_000), DimJoin(b, "y", "b_k", how, SHUFFLED, rows=2_000_000)]
    got, plain = star_join(fact, joins), fact.join(a, fact.x == a.a_k, how).join(b, fact.y == b.b_k, how)
    assert "shufflepartitionidpassthrough" in plan_of(got)
    rows = lambda df: sorted(map(tuple, df.collect()), key=repr)
    assert rows(got) == rows(plain) and got.columns == plain.columns


def test_grid_is_bounded():
    assert _grid(900_000, 1_200_000, 1) == (2, 3)
    assert _grid(5_400_000, 7_200_000, 50) == (11, 15)      # a part stays as small as a broadcast
    a, b = _grid(900_000, 1_200_000, 10_000)
    assert max(a, b) <= GRID_MAX_COPIES
    assert _grid(GRID_MAX_ROWS * GRID_MAX_COPIES + 1, 1_000, 50) is None


def test_increments_and_keys_of_other_types_meet_no_copies(spark, zone):
    z = large(zone)
    part = with_fact(z, "RAW_FACT_ONLINESALES", z["RAW_FACT_ONLINESALES"])
    assert z.copied("RAW_DIMCUSTOMER") == BROADCAST_MAX_ROWS + 1 and part.copied("RAW_DIMCUSTOMER") is None
    assert "shufflepartitionidpassthrough" not in plan_of(views.master_online(part))
    fact, dim = spark.range(3).selectExpr("id x", "cast(id as int) y"), spark.range(3)
    joins = [DimJoin(dim.selectExpr(f"id {p}_k"), k, f"{p}_k", "inner", SHUFFLED, rows=600_000) for k, p in (("x", "a"), ("y", "b"))]
    assert star_join(fact, joins).count() == 3


def test_counting_carries_no_keys_of_broadcast_dimensions(zone):
    z = large(zone)
    at = views._store_star(z, views.DROP, True, texts=False).columns.index
    assert at("s_StoreName") < at("p_ProductKey") and at("d_DateKey") < at("p_ProductKey")
    at = views._online_star(z, views.DROP, True, texts=False).columns.index
    assert at("cur_CurrencyName") < at("c_CustomerKey")
    at = views._online_star(z, views.DROP, True).columns.index
    assert at("p_ProductKey") < at("d_CalendarYear")      # the year doesn't travel with the fact


def made_zone(spark) -> RawZone:
    """Rows of own making: 25 keys a table, dates of five years, all else NULL; the online fact is shuffled to be made."""
    def made(f: T.StructField) -> str:
        key, day = f.name.endswith("Key"), "DATE'1997-05-01' + CAST(365 * (id % 5) AS INT)"
        if isinstance(f.dataType, (T.LongType, T.DecimalType)) and (key or f.name.startswith("Unit")):
            return "id"
        if f.name == "DateKey":
            return day.replace("(id % 5)", "id") if isinstance(f.dataType, T.DateType) else f"CASE WHEN id < 24 THEN {day} END"
        return "NULL"
    tables = {n: spark.range(25).selectExpr(*[f"CAST({made(f)} AS {f.dataType.simpleString()}) AS {f.name}" for f in s.fields]) for n, s in schemas.RAW_TABLES.items()}
    return RawZone({**tables, "RAW_FACT_ONLINESALES": tables["RAW_FACT_ONLINESALES"].repartition(3, "OnlineSalesKey")})


def shuffle_files(spark) -> set[str]:
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {name for name in (files.apply(i).getName() for i in range(files.size())) if name.startswith("shuffle_")}


def gone(spark, before: set[str]) -> bool:
    """Whether no other shuffle files than these are left; they are removed a moment after the write."""
    end = time.time() + 20
    while shuffle_files(spark) - before and time.time() < end:
        time.sleep(0.1)
    return not shuffle_files(spark) - before


def staged_names(path: str) -> list[str]:
    return [f for _, _, names in os.walk(local_path(path)) for f in names if f.startswith("part-")]


def test_gzipped_extracts_load_the_same_rows(spark, tmp_stage, monkeypatch):
    monkeypatch.setattr(sink, "GZIPPED_RECORDS", 10)
    z, before = made_zone(spark), shuffle_files(spark)
    stage_extracts(z, f"{tmp_stage}/stage", gzipped=True)
    assert gone(spark, before)      # staging leaves no shuffle behind
    assert all(f.endswith(".csv.gz") for f in staged_names(f"{tmp_stage}/stage"))
    assert len(staged_names(f"{tmp_stage}/stage/FactSales_1")) >= 3
    loaded = RawZone.from_csv(spark, f"{tmp_stage}/stage", f"{tmp_stage}/zone", gzipped=True)
    rows = lambda df: sorted(map(tuple, df.collect()), key=repr)
    for name in z.tables:
        assert rows(loaded[name]) == rows(z[name]), name
    # the plain names of the facts are not taken for packed ones, nor the other way round
    assert RawZone.from_csv(spark, f"{tmp_stage}/stage", f"{tmp_stage}/plain")["RAW_FACTSALES"].count() == 0
    written = [f for f in staged_names(f"{tmp_stage}/zone") if f.endswith(".parquet")]
    assert written and all(f.endswith(".zstd.parquet") for f in written)


def test_writes_within_remove_their_shuffles(spark, tmp_stage):
    was, before = spark.conf.get(SHUFFLE_CLEANUP), shuffle_files(spark)
    with shuffles_removed(spark):
        spark.range(1000).repartition(5, "id").write.parquet(f"{tmp_stage}/a")
        assert spark.conf.get(SHUFFLE_CLEANUP) == "true"
    assert gone(spark, before) and spark.read.parquet(f"{tmp_stage}/a").count() == 1000
    with pytest.raises(ValueError), shuffles_removed(spark):
        raise ValueError
    assert spark.conf.get(SHUFFLE_CLEANUP) == was


@pytest.mark.parametrize("name, stem, query", [("RAW_FACTSALES", "FactSales", "rpt_sales_master"), ("RAW_FACT_ONLINESALES", "FactOnlineSales", "rpt_online_master")])
def test_increments_are_staged_packed_and_loaded_once(spark, tmp_stage, monkeypatch, name, stem, query):
    z = made_zone(spark)
    monkeypatch.setattr(ingest_queries, "_zone", lambda *_: z)
    monkeypatch.setattr(load_queries, "scratch_path", lambda *_: tmp_stage)
    loaded = load_queries._increments(spark, "", name, stem)
    staged = staged_names(f"{tmp_stage}/stage")
    assert staged and all(f.endswith(".csv.gz") for f in staged)
    rows = lambda df: sorted(map(tuple, df.collect()), key=repr)
    # the torn loads' rows lie beside, unseen; bulk files are not read again
    assert rows(loaded[name]) == rows(z[name])
    history = RawZone.loaded(spark, f"{tmp_stage}/zone", name).history().groupBy("commit").agg(F.sum("loaded").alias("n"))
    assert {r["commit"]: r["n"] for r in history.collect()} == {0: 5, 1: 10, 2: 10}
    torn = [d for d, _, fs in os.walk(local_path(f"{tmp_stage}/zone")) if f"{name}/data" in d and d.endswith("verdict=good")]
    assert len(torn) == 5
    view = rows(QUERIES[query](loaded))
    assert len(view) == 24 and view == rows(QUERIES[query](z))


def test_zone_of_the_view_is_loaded_from_packed_extracts(spark, tmp_stage, monkeypatch):
    z = made_zone(spark)
    monkeypatch.setattr(ingest_queries, "_zone", lambda *_: z)
    monkeypatch.setattr(ingest_queries, "scratch_path", lambda *_: tmp_stage)
    got = ingest_queries.rpt_sales_master_from_csv(spark, "")
    staged = staged_names(f"{tmp_stage}/stage")
    assert staged and all(f.endswith(".csv.gz") for f in staged)
    loaded = RawZone.current(spark, f"{tmp_stage}/zone")
    assert all(loaded[n].count() == 25 for n in z.tables)
    rows = lambda df: sorted(map(tuple, df.collect()), key=repr)
    assert len(rows(got)) == 24 and rows(got) == rows(QUERIES["rpt_sales_master"](z))
